"""Timestamps, CSV headers and rescued JSON."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwheel import schemas
from cartwheel.functions import timestamps as T
from cartwheel.operators import joins
from cartwheel.sources import files


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


CASES = {
    "2024-01-01T00:00:00+05:00": 1704049200, "2024-01-01 00:00:00Z": 1704067200, "2024-01-01T00:00:00": 1704067200,
    "2024-03-10 02:30:00": 1710037800, "2024-11-03 01:30:00": 1730597400, "2024-11-03 06:30:00.250": 1730615400,
    "2024-01-01 00:00:00 America/New_York": 1704085200, "2024-01-01": 1704067200, "2024-01-01 00:00:00-03:30": 1704079800,
    "nonsense": None, "2024-13-01 00:00:00": None,
}


def test_parse_is_independent_of_the_session_zone(spark, zone):
    df = spark.createDataFrame([(k,) for k in CASES], "t string")
    got = {r.t: r.s for r in df.select("t", F.unix_millis(T.parse_timestamp("t")).alias("s")).collect()}
    assert {k: v if v is None else v // 1000 for k, v in got.items()} == CASES


def test_round_trips_at_dst_changes(spark, zone):
    df = spark.createDataFrame([(s * 1000 + 123,) for s in CASES.values() if s], "ms long").withColumn("t", F.timestamp_millis("ms"))
    back = df.select("ms", F.unix_millis(T.strip_event_time("t")).alias("a"), F.unix_millis(T.as_instant(T.as_wallclock("t"))).alias("b"), F.unix_millis(T.parse_timestamp(T.format_wallclock("t"))).alias("c"))
    assert all(r.ms == r.a == r.b == r.c for r in back.collect())


def test_csv_columns_by_header(spark, tmp_path):
    names = schemas.customers_csv().names
    values = {"user_id": "u1", "age": "30", "gender": "M", "user_updated_at": "2024-01-01 10:00:00", "return_rate": "0.5", "country": "ES"}
    order = ["user_updated_at", "extra", *reversed([n for n in names if n != "user_updated_at"])]
    (tmp_path / "a.csv").write_text(",".join(order) + "\n" + ",".join(values.get(n, "") for n in order) + "\n")
    r = files.read_customers_csv(spark, str(tmp_path)).collect()[0]
    assert (r.user_id, r.age, r.gender, r.return_rate, r.country) == ("u1", 30, "M", 0.5, "ES")
    assert r.user_updated_at == datetime(2024, 1, 1, 10)
    other = tmp_path / "other"
    other.mkdir()
    (other / "a.csv").write_text("user_id,age\nu1,3\n")
    with pytest.raises(ValueError, match="lacks"):
        files.read_customers_csv(spark, str(other))


def test_json_rescue_keeps_what_the_schema_lacks(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"session_id":"s1","will_abandon":1,"label_available_date":"2024-01-01T00:00:00","new":5}\nnot json\n{"session_id":"s2"}\n{"session_id":"s3","will_abandon":"x"}\n')
    schema = StructType.fromDDL(schemas.LABELS_JSON_DDL)
    got = {r.session_id: r for r in files.read_json(spark, str(tmp_path), schema, rescue=True).collect()}
    assert got["s1"]._rescued_data == '{"new":"5"}' and got["s1"].will_abandon == 1
    assert got["s2"]._rescued_data is None and got["s2"].source_file.endswith("a.json")
    assert got[None]._rescued_data == "not json"
    assert got["s3"]._rescued_data.startswith('{"session_id":"s3"')


def test_version_lookup_equals_validity_join_and_is_linear(spark):
    hist = spark.range(3000).select(F.lit("u").alias("user_id"), F.timestamp_seconds(F.col("id") * 10).alias("__START_AT"), F.when(F.col("id") % 7 == 0, F.timestamp_seconds(F.col("id") * 10 + 4)).when(F.col("id") < 2999, F.timestamp_seconds(F.col("id") * 10 + 10)).alias("__END_AT"), F.col("id").alias("v"))
    left = spark.range(3000).select(F.lit("u").alias("user_id"), F.timestamp_seconds(F.col("id") * 11 - 50).alias("ts"), "id")
    fast = joins.version_lookup(left, hist, "user_id", "ts", ["v"])
    assert "residual" not in fast._jdf.queryExecution().executedPlan().toString()
    slow = joins.validity_join(left, hist, "user_id", "ts", value_cols=["v"])
    assert {(r.id, r.v) for r in fast.collect()} == {(r.id, r.v) for r in slow.collect()}
