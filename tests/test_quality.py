"""Rule catalogue, routing under three-valued logic, metrics, parsing."""

import pytest
from pyspark.sql import functions as F

from cartwheel.functions.rules import CATALOGUE, Rule, RuleCatalogueError, rules_for
from cartwheel.functions.timestamps import parse_timestamp
from cartwheel.operators import quality

CUST = ("user_id string, user_type string, age int, gender string, country string, "
        "preferred_device string, registration_date date, return_rate double, "
        "has_app_installed int, email_opt_in int, user_updated_at timestamp")


def test_rule_counts_per_tag():
    assert [len(rules_for(t)) for t in ("customers", "transactions", "labels")] == [11, 6, 3]


def test_unknown_tag_and_duplicate_name_raise():
    with pytest.raises(RuleCatalogueError):
        rules_for("nope")
    dup = CATALOGUE + (Rule("valid_user_id", "TRUE", "customers"),)
    with pytest.raises(RuleCatalogueError):
        rules_for("customers", dup)


def _customers(spark):
    from datetime import date, datetime
    ok = ("1", "guest", 30, "M", "ES", "mobile", date(2020, 1, 1), 0.1, 1, 0, datetime(2021, 1, 1))
    null_age = ("2", "guest", None, "M", "ES", "mobile", date(2020, 1, 1), 0.1, 1, 0,
                datetime(2021, 1, 1))
    bad = ("3", "guest", 12, "M", "ESP", "mobile", date(2020, 1, 1), 0.1, 1, 0,
           datetime(2021, 1, 1))
    return spark.createDataFrame([ok, null_age, bad], CUST)


def test_null_operand_routing_modes(spark):
    df = _customers(spark)
    clean_ref, bad_ref = quality.split(df, "customers", on_null="reference")
    assert [r.user_id for r in clean_ref.collect()] == ["1"]
    assert [r.user_id for r in bad_ref.collect()] == ["3"]      # NULL-flag row is lost
    clean, bad = quality.split(df, "customers")
    assert [r.user_id for r in clean.collect()] == ["1"]
    assert sorted(r.user_id for r in bad.collect()) == ["2", "3"]
    rec = quality.reconciliation(df, "customers").collect()[0]
    assert (rec.rows_in, rec.clean, rec.quarantined, rec.lost, rec.quarantined_null_safe) == \
        (3, 1, 1, 1, 2)


def test_expectation_metrics_count_null_as_failed(spark):
    m = {r.rule: (r.passed, r.failed)
         for r in quality.expectation_metrics(_customers(spark), "customers").collect()}
    assert m["valid_age"] == (1, 2)
    assert m["valid_country"] == (2, 1)
    assert m["valid_user_id"] == (3, 0)


def test_rule_with_or_is_parenthesised(spark):
    df = spark.createDataFrame([(1, 5), (2, 50)], "a int, b int")
    rules = {"r1": "a = 1 OR a = 2", "r2": "b < 10"}
    clean, bad = quality.split(df, rules)
    assert [r.a for r in clean.collect()] == [1]
    assert [r.a for r in bad.collect()] == [2]


def test_malformed_timestamp_is_null_not_abort(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.123456",), ("garbage",), (None,)], "t string")
    got = [r.p for r in df.select(parse_timestamp("t").alias("p")).collect()]
    assert got[0] is not None and got[1] is None and got[2] is None


def test_impute_sequence_uses_registration_date(spark):
    out = quality.impute_sequence(_customers(spark).withColumn("user_updated_at", F.lit(None)
                                                                .cast("timestamp")))
    assert all(r.user_updated_at is not None for r in out.collect())


def test_observed_expectations_batch(spark):
    from pyspark.sql import Observation
    obs = Observation("customers")
    df = quality.observe_expectations(_customers(spark), "customers", obs)
    assert df.count() == 3                      # rows flow through unchanged
    m = obs.get
    assert m["rows"] == 3 and m["valid_age"] == 2 and m["valid_country"] == 1


def test_wallclock_conversion_is_session_zone_independent(spark):
    from cartwheel.functions.timestamps import as_instant, as_wallclock
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.sql("SELECT timestamp_ntz'2024-01-15 10:30:00.123456' AS w")
            r = df.select(F.unix_micros(as_instant("w")).alias("us"),
                          as_wallclock(as_instant("w")).alias("back")).collect()[0]
            assert r.us == 1705314600123456, zone
            assert str(r.back) == "2024-01-15 10:30:00.123456", zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_write_routed_single_pass_keeps_null_flag_rows(spark):
    import tempfile
    from pyspark.sql import Observation
    path = tempfile.mkdtemp(prefix="cartwheel-routed-test-") + "/routed"
    obs = Observation("routed")
    clean, bad = quality.write_routed(_customers(spark), "customers", path, "reference", obs)
    assert [r.user_id for r in clean.collect()] == ["1"]
    assert [r.user_id for r in bad.collect()] == ["3"]
    stored = spark.read.parquet(path)
    assert stored.filter(F.col("is_quarantined").isNull()).count() == 1   # visible, not lost
    assert obs.get["rows"] == 3


@pytest.mark.parametrize("fails", [False, True])
def test_write_routed_sorts_no_split_by_the_flag(spark, monkeypatch, tmp_path, fails):
    # Spark sorts what a task writes by the partition column unless it may keep a file open per value
    from pyspark.sql import DataFrameWriter
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(name)

    def parquet(self, path, *args, **kwargs):
        seen.append(int(spark.conf.get(name)))
        if fails:
            raise RuntimeError("disk full")
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    if fails:
        with pytest.raises(RuntimeError):
            quality.write_routed(_customers(spark), "customers", str(tmp_path / "routed"), "reference")
    else:
        clean, bad = quality.write_routed(_customers(spark), "customers", str(tmp_path / "routed"), "reference")
        assert clean.count() == bad.count() == 1
        assert spark.read.schema(f"user_id string, {quality.FLAG} boolean").parquet(str(tmp_path / "routed")).filter(f"{quality.FLAG} IS NULL").count() == 1
    assert seen == [3] and spark.conf.get(name) == before
