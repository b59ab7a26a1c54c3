"""Headers by file, and inputs found by path."""

import os

import pytest
from pyspark.sql import types as T

from orderlens.operators import performance as perf
from orderlens.operators import profile as pr
from orderlens.operators import queries as q
from orderlens.plans.end_to_end import validate_paths
from orderlens.plans.landing import typed_orders
from orderlens.sources import csv as csvio
from orderlens.sources import kv_tsv, paths, tables
from tests.conftest import SF_SMALL


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def abc():
    return T.StructType([T.StructField(n, T.StringType()) for n in "abc"])


def test_header_drift_is_reported_by_file(spark, tmp_dir):
    put(f"{tmp_dir}/h/good.csv", "\n" + 'a,"b, or ""B""",c\n1,2,3\n')
    put(f"{tmp_dir}/h/swapped.csv", 'c,"b, or ""B""",a\r\n')
    put(f"{tmp_dir}/h/more.csv", "a,a,,x\n" + "1,2,3\n" * 50)
    put(f"{tmp_dir}/h/empty.csv", "")
    headers = csvio.file_headers(spark, f"{tmp_dir}/h")
    got = {os.path.basename(r.file): list(r.header) for r in headers.collect()}
    assert got == {"good.csv": ["a", 'b, or "B"', "c"], "swapped.csv": ["c", 'b, or "B"', "a"], "more.csv": ["a", "a", "", "x"]}
    found = {(os.path.basename(r.file), r.column, r.status) for r in
             pr.schema_check_by_file(headers, ["a", 'b, or "B"', "c"]).where("status <> 'ok'").collect()}
    assert found == {("swapped.csv", "a", "misplaced"), ("swapped.csv", "c", "misplaced"), ("more.csv", 'b, or "B"', "missing"),
                     ("more.csv", "c", "missing"), ("more.csv", "", "unexpected"), ("more.csv", "x", "unexpected"),
                     ("more.csv", "a", "duplicate")}


def test_a_header_is_dropped_at_a_files_start_only(spark, tmp_dir):
    put(f"{tmp_dir}/d d/one.csv", "a,b,c\n1,2,3\na,b,c\n4,5,6\n")
    put(f"{tmp_dir}/d d/two.csv", '7,8,9\n10,"11\n11",12\n')
    put(f"{tmp_dir}/d d/none.csv", "")
    df = csvio.read_csv_with_headers(spark, f"{tmp_dir}/d d", abc(), ["a", "b", "c"])
    got = sorted((r.a, r.b, r.c) for r in df.collect())
    assert got == [("1", "2", "3"), ("10", "11\n11", "12"), ("4", "5", "6"), ("7", "8", "9"), ("a", "b", "c")]
    put(f"{tmp_dir}/e/none.csv", "")
    assert csvio.read_csv_with_headers(spark, f"{tmp_dir}/e", abc(), ["a", "b", "c"]).count() == 0


def test_paths(spark, tmp_dir):
    there = put(f"{tmp_dir}/x/part-0.txt", "1")
    assert paths.exists(spark, there) and paths.exists(spark, f"file://{tmp_dir}/x") and paths.exists(spark, f"{tmp_dir}/x/part-*")
    assert not paths.exists(spark, f"{tmp_dir}/y") and not paths.exists(spark, f"{tmp_dir}/x/*.csv")
    assert paths.first_existing(spark, f"{tmp_dir}/y", there) == there and paths.first_existing(spark, f"{tmp_dir}/y") is None
    with pytest.raises(FileNotFoundError, match="y.*z"):
        paths.resolve(spark, f"{tmp_dir}/y", f"{tmp_dir}/z")


def test_validation_report_from_paths_has_every_status(spark, tmp_dir):
    orders = typed_orders(spark, SF_SMALL)
    kv_tsv.write_tsv(perf.restaurant_performance(orders, "restaurant_name"), f"{tmp_dir}/rollup_2", style="kv")
    csvio.write_csv(q.with_title(q.rating_by_restaurant(orders), q.TITLES["q10"]), f"{tmp_dir}/q10")
    tables.save_typed(orders, path=f"{tmp_dir}/orc")
    csvio.write_clean_csv(orders, f"{tmp_dir}/csv")
    rollup = [f"{tmp_dir}/rollup_1", f"{tmp_dir}/rollup_2"]  # the second is the fallback
    # the validator counts negative minutes, the roll-up does not: the difference is published, so the tolerance allows for it
    report = lambda clean, **k: validate_paths(spark, k.pop("rollup", rollup), f"{tmp_dir}/q10", clean, **k).first()
    assert report(f"{tmp_dir}/orc").status == "SUCCESS" and len(report(f"{tmp_dir}/orc").metrics_validation) > 0
    assert report([f"{tmp_dir}/no", f"{tmp_dir}/csv"], fmt="csv").status == "SUCCESS"
    tables.save_typed(orders.limit(50), path=f"{tmp_dir}/some")
    assert report(f"{tmp_dir}/some", tolerance=0.0001).status == "MISMATCH"
    assert report([f"{tmp_dir}/no", f"{tmp_dir}/nor"]).status == "SKIPPED_NO_CLEAN_DATA"
    tables.save_typed(orders.limit(0), path=f"{tmp_dir}/none")
    assert report(f"{tmp_dir}/none").status == "SKIPPED_NO_CLEAN_DATA"
    assert report(f"{tmp_dir}/orc", rollup=f"{tmp_dir}/rollup_1").status.startswith("ERROR: none of these paths exists")
    put(f"{tmp_dir}/broken/part-0.orc", "this is no table")
    assert report(f"{tmp_dir}/broken").status.startswith("ERROR")
