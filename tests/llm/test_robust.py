"""Long runs of one character, bad html, and columns and rows that clash with the operators' own."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartwheel.llm import packing, pages

WEIGHTS = {"": 1.0, "*": -0.5}


@pytest.mark.parametrize("char", [" ", "\n", "\t", "　", "a", "7", "!", "é", "漢"])
def test_ids_of_long_runs_are_those_of_the_tokenizer(char):
    encode = packing.encoder()
    text = "Some words" + char * 1_000_000 + "and more."
    assert encode(text) == encode.reference(text)


def test_white_space_near_the_limit():
    encode = packing.encoder()
    for n in (19_990, 19_999, 20_000, 20_001):
        assert encode("a" + " " * n + "b") == encode.reference("a" + " " * n + "b")


def test_packing_takes_a_text_of_white_space(spark):
    docs = spark.createDataFrame([(1, "\n" * 1_000_000), (2, "x"), (3, None)], "doc_id long, text string")
    assert packing.pack(docs).select("doc_id").distinct().count() == 3


@pytest.mark.parametrize("html", ["<b>" * 40_000 + "x" + "</i>" * 40_000, "<a " * 100_000, "<i><div>" + "<b>" * 40_000 + "</i>" * 40_000, "<a href='" * 50_000 + ">",
                                  "<script>" * 50_000, "<!--" * 100_000, "<p>" * 50_000 + "</div>" * 50_000, '<a b="' * 60_000, "</" * 200_000])
def test_bad_html_takes_time_by_its_length(html):
    began = time.process_time()
    pages.Page(html).main_text(WEIGHTS)
    assert time.process_time() - began < 8


def text(html):
    return pages.Page(html).main_text(WEIGHTS)


def test_quoted_values_and_unfinished_markup():
    assert text('<article><p title="a > b">one two three</p></article>') == "one two three"
    assert text("<article><p data-x='>'>one two</p><p>it's three</p></article>") == "one two it's three"
    assert text("<article><p>one two</p></article><!-- never > ended") == "one two"
    assert text("<article><p>one two</p></article><script>var a = '>';") == "one two"
    assert text("<article><p>don't <b>stop</i> me</b> now</p></article>") == "don't stop me now"


CLASH = ["score", "_text", "_k1", "_k2", "text2", "__text", "row", "_id"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    bad = ["lorem xx zz qq " * 3, "buy now click here cheap"]
    good = [f"The {a} sat on the {b} while people read about {a} and {b} in a long and quiet evening." for a in ("cat", "dog", "owl") for b in ("mat", "log", "rug")]
    rows = [(i, good[i % 9] if i % 3 else bad[i % 2]) for i in range(40)] + [(5, good[5])] * 300 + [(None, None), (41, ""), (None, good[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(f"own {c}") for c in CLASH})
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([("q1", "an item that no document holds")], "item_id string, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_leave_clashing_columns_alone(spark, tables, name, stage):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = stage(spark, docs, tables)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"own {c}" for r in rows for c in CLASH)
    if name == "exact_dedup":
        assert len({(r.text or "").replace(" ", "") for r in rows}) == len(rows)


def test_sample_bound_holds_for_repeated_ids(spark):
    from cartwheel.llm import quality

    docs = spark.createDataFrame([(1, "one two")] * 3000 + [(2, "three four")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels, rows=2)
    again = quality.train(docs.distinct(), labels, rows=2)
    assert (model == again).all()


def test_spans_are_taken_out_and_the_rest_stays(spark):
    from cartwheel.llm import decontaminate

    item = "What is the name of the tall red bird that sings at night in spring"      # 15 words
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(1, f"Été: {long}! {item.upper()}, and so on.", "a"), (2, f"{item} tail", "b"), (3, "short one here", "c"), (4, None, "d"), (4, None, "d"),
            (5, f"{long} tiny item {long}", "e"), (6, "x tiny ITEM y", "f"), (7, f"{long} {item} {item}.", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _cut string")
    items = spark.createDataFrame([("q1", item), ("q2", "tiny item"), ("q3", None)], "item_id string, text string")
    for block in (500_000, 5):
        got = decontaminate.remove_spans(docs, items, block_words=block)
        assert got.columns == docs.columns
        texts = {r.doc_id: r.text for r in got.collect()}
        assert got.count() == 8 and {r._cut for r in got.collect()} == set("abcdefg")
        assert texts == {1: f"Été: {long}! , and so on.", 2: " tail", 3: "short one here", 4: None, 5: f"{long} tiny item {long}", 6: "x  y", 7: f"{long} ."}
    assert decontaminate.remove_spans(docs, items.limit(0)).exceptAll(docs).count() == 0
