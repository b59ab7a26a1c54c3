"""Records, numbers, timestamps and text cells at their edges."""

import datetime as dt
import json
import os

import pytest

from orderlens.functions.expr import parse_number, to_double, to_ts
from orderlens.operators import clean as cl
from orderlens.operators import profile as pr
from orderlens.operators import scorecard as sc
from orderlens.plans.landing import raw_staging, typed_orders
from orderlens.schema import METRICS, RAW_HEADERS
from orderlens.session import work_dir
from orderlens.sources import csv as csvio
from orderlens.sources import kv_tsv
from orderlens.streaming.ingest import start_reject_ingest
from pyspark.sql import functions as F
from tests.conftest import SF_ORACLE

LONG = 1_000_000


def _write(path, lines):
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def long_records(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long") / "raw")
    header = ",".join(f'"{h}"' if "," in h else h for h in RAW_HEADERS)
    quoted = '"' + 'a""b,' * (LONG // 5) + '"'
    _write(path, [header, f"7,{quoted},x", ",".join(["1", "A"] + [""] * 27)])
    return path


def test_long_quoted_field_in_a_short_record_batch(spark, long_records):
    raw = csvio.read_csv(spark, long_records, csvio.RAW_29, maxCharsPerColumn=-1)
    accepted, rejected = csvio.split_rejects(raw)
    row = rejected.collect()
    assert [(r.first_field, r.fields) for r in row] == [("7", 3)] and len(row[0].record) > LONG
    assert accepted.count() == 1


def test_long_quoted_field_in_a_short_record_stream(spark, long_records, tmp_dir):
    q = start_reject_ingest(spark, long_records, f"{tmp_dir}/rej", f"{tmp_dir}/ck")
    q.awaitTermination(120)
    assert [(r.first_field, r.fields) for r in spark.read.json(f"{tmp_dir}/rej").collect()] == [("7", 3)]


def test_header_rows_go_by_the_whole_row(spark):
    df = spark.createDataFrame([("id", "name"), ("id", "other"), ("identity", "name"), (None, "name")], "id string, name string")
    assert sorted(map(tuple, csvio.skip_header_rows(df, ["id", "name"]).collect()), key=repr) == [
        ("id", "other"), ("identity", "name"), (None, "name")]


def test_numbers_with_type_suffix_or_hex_are_no_numbers(spark):
    cases = {"12d": None, "12f": None, "5D": None, "5F": None, "0x1p3": None, "0X1": None, "1e3": 1000.0, "-.5": -0.5,
             "inf": None, "-Infinity": None, "nan": None, "": None, " 7 ": 7.0, "1_0": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.x for r in df.select("v", to_double("v").alias("x")).collect()}
    assert got == cases
    assert df.filter("v = 'inf'").select(parse_number(F.col("v"))).first()[0] == float("inf")


TIMES = {
    "9:05 PM, September 10 2024": dt.datetime(2024, 9, 10, 21, 5), "09:05 PM, September 1 2024": dt.datetime(2024, 9, 1, 21, 5),
    "1/2/2024 3:04": dt.datetime(2024, 1, 2, 3, 4), "2024-03-10 02:30:00": dt.datetime(2024, 3, 10, 2, 30),
    "2024-11-03 01:30:00": dt.datetime(2024, 11, 3, 1, 30), "2024-09-01 10:00:00.123": dt.datetime(2024, 9, 1, 10, 0, 0, 123000),
    "2024-09-01T10:00:00Z": dt.datetime(2024, 9, 1, 10), "2024-09-01T10:00:00+05:30": dt.datetime(2024, 9, 1, 4, 30),
    "2024-9-1": dt.datetime(2024, 9, 1), "1969-12-31 23:59:59": dt.datetime(1969, 12, 31, 23, 59, 59), "not a date": None,
    "2024-02-30 00:00:00": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k,) for k in TIMES], "v string")
        rows = df.select("v", to_ts("v").cast("string").alias("t")).collect()
        want = {k: None if v is None else v.isoformat(" ")[:23] for k, v in TIMES.items()}
        assert {r.v: r.t for r in rows} == want
        assert dict(df.select(to_ts("v").alias("t")).dtypes)["t"] == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_tabs_at_the_edges_of_kv_lines(spark, tmp_dir):
    _write(f"{tmp_dir}/kv", ["Name\torder_count=5\t", "\tid1\tOther\torder_count=6", "\t\t", "  ", "order_count=9"])
    got = [tuple(r)[:3] for r in kv_tsv.read_kv_tsv(spark, f"{tmp_dir}/kv").collect()]
    assert got == [(None, "Name", 5.0), ("id1", "Other", 6.0)]


def test_null_names_keep_their_cell_in_tsv(spark, tmp_dir):
    df = spark.createDataFrame([("1", None, 3, 2.0, 1.0, None, 4.0)],
                               "restaurant_id string, restaurant_name string, order_count long, total_revenue double, "
                               "avg_order_value double, avg_kpt double, avg_rider_wait double")
    kv_tsv.write_tsv(df, f"{tmp_dir}/p")
    assert tuple(kv_tsv.read_plain_tsv(spark, f"{tmp_dir}/p").first()) == ("1", None, 3, 2.0, 1.0, None, 4.0)


def test_empty_string_and_null_survive_a_csv_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("a", ""), ("b", None), ("c", " x ")], "k string, v string")
    csvio.write_csv(df, f"{tmp_dir}/c")
    back = csvio.read_csv(spark, f"{tmp_dir}/c", df.schema, keep_corrupt=False)
    assert sorted(map(tuple, back.collect())) == [("a", ""), ("b", None), ("c", " x ")]


def test_flags_without_any_value_are_false(spark):
    df = spark.createDataFrame([("a", 3, 10.0, 3.3, None, None, None, None), ("b", 4, 12.0, 3.0, None, None, None, None)], METRICS)
    for r in sc.scorecard(df).collect():
        assert (r.kpt_flag, r.wait_flag, r.bottleneck, r.growth_opportunity) == (False, False, False, False)


def test_fixture_reaches_the_branches(spark):
    raw, orders = raw_staging(spark, SF_ORACLE), typed_orders(spark, SF_ORACLE)
    clean = cl.clean_orders(raw)
    n = clean.count()
    assert 0 < n - cl.reject_empty_keys(clean).count() < n / 50
    assert orders.filter("kpt_duration_minutes < 0").count() > 0 and orders.filter("rider_wait_time_minutes < 0").count() > 0
    audit = {r.column: r for r in pr.numeric_audit(raw).collect()}
    assert sum(r.non_numeric > 0 for r in audit.values()) >= 3 and sum(r.negatives > 0 for r in audit.values()) >= 3
    assert sum(r.max is not None for r in audit.values()) >= 11
    from orderlens.plans.landing import restaurant_metrics
    m = restaurant_metrics(spark, SF_ORACLE, "restaurant_id")
    assert m.filter("avg_rating is null").count() == 1


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://somewhere:7077"
        getConf = staticmethod(lambda: {})
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda *_: None)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError):
        work_dir(Session)


EVENTS = """
import json, sys, os
sys.path.insert(0, {repo!r})
from orderlens.session import local_session
from orderlens.plans.end_to_end import run_end_to_end
from orderlens.plans.landing import write_table
from orderlens.sources import csv as csvio
from orderlens.sources.fixtures import food_orders, food_orders_raw
from orderlens.schema import COLUMN_TO_HEADER
s = local_session(2, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{tmp}/ev",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": {threshold!r}, "spark.sql.adaptive.autoBroadcastJoinThreshold": {threshold!r},
    "spark.checkpoint.dir": "file://{tmp}/ck"}})
job = {job!r}
if job == "land":
    s.sparkContext.setJobGroup("land", "land")
    write_table(food_orders(s, {sf!r}), "t")
else:
    raw = food_orders_raw(s, {sf!r})
    csvio.write_csv(raw.select(*[raw[c].alias(COLUMN_TO_HEADER[c]) for c in raw.columns]), "{tmp}/raw")
    run_end_to_end(s, "{tmp}/raw", "{tmp}/out")
s.stop()
"""


def _events(tmp, job, threshold="-1"):
    import subprocess
    import sys

    os.makedirs(f"{tmp}/ev")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = EVENTS.format(repo=repo, tmp=tmp, sf=SF_ORACLE, job=job, threshold=threshold)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=600, capture_output=True)
    (name,) = os.listdir(f"{tmp}/ev")
    with open(f"{tmp}/ev/{name}") as f:
        return [json.loads(line) for line in f]


def test_landing_scans_and_shuffles_each_order_once(spark, tmp_dir):
    orders = spark.read.parquet(f"{SF_ORACLE}/orders.parquet").count()
    customers = spark.read.parquet(f"{SF_ORACLE}/customer.parquet").count()
    ends = [e for e in _events(tmp_dir, "land") if e["Event"] == "SparkListenerTaskEnd"]
    read = sum(e["Task Metrics"]["Input Metrics"]["Records Read"] for e in ends)
    wrote = sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"] for e in ends)
    assert orders <= read <= orders + customers + 60  # the dimensions have 30 rows
    assert orders <= wrote <= orders + 3 * customers + 60


def test_end_to_end_parses_the_raw_text_once(tmp_dir):
    events = _events(tmp_dir, "e2e", threshold="10m")
    size = sum(os.path.getsize(f"{tmp_dir}/raw/{f}") for f in os.listdir(f"{tmp_dir}/raw") if f.endswith(".csv"))
    scans = [e for e in events if "sparkPlanInfo" in e and "Scan csv" in json.dumps(e["sparkPlanInfo"])
             and f"{tmp_dir}/raw" in json.dumps(e["sparkPlanInfo"])]
    assert len({e["executionId"] for e in scans}) == 1, size
