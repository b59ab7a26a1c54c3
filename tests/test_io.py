"""Small file fixtures: raw CSV, bad header, quoting, key=value TSV, plain TSV,
JSON reports, typed tables, catalog, file usage."""

import os

import pytest

from orderlens.operators import clean as cl
from orderlens.operators import profile as pr
from orderlens.schema import COLUMNS, RAW_HEADERS
from orderlens.sources import csv as csvio
from orderlens.sources import kv_tsv, reports, tables


def _q(v):
    return '"' + v.replace('"', '""') + '"' if any(ch in v for ch in ',"\n') else v


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def _raw_row(i, **over):
    vals = {h: "" for h in RAW_HEADERS}
    vals.update({"Restaurant ID": f" {100 + i % 2}", "Restaurant name": " Swaad\t", "City": "Delhi",
                 "Order ID": str(i), "Order Placed At": "11:38 PM, September 10 2024",
                 "Order Status": "Delivered", "Distance": "<1km", "Bill subtotal": "100.5",
                 "Total": str(90 + i), "Rating": "4", "KPT duration (minutes)": "12.5",
                 "Rider wait time (minutes)": "3", "Instructions": 'ring, then say "hi"'})
    vals.update(over)
    return ",".join(_q(vals[h]) for h in RAW_HEADERS)


@pytest.fixture
def raw29(tmp_dir):
    lines = [",".join(_q(h) for h in RAW_HEADERS)]
    lines += [_raw_row(i) for i in range(8)]
    lines.append(_raw_row(8, **{"Total": "-5", "Rating": "", "Order Placed At": "garbage"}))
    lines.append(_raw_row(9, **{"Bill subtotal": "abc", "Review": "multi\nline review"}))
    return _write(os.path.join(tmp_dir, "raw29.csv"), lines)


def test_raw_csv_to_clean(spark, raw29):
    raw = csvio.read_raw_csv(spark, raw29, multiline=True)
    assert raw.columns[:29] == RAW_HEADERS
    accepted, rejected = csvio.split_rejects(raw)
    assert rejected.count() == 0
    clean = cl.clean_orders(accepted)
    assert clean.columns == COLUMNS
    rows = {r.order_id: r for r in clean.collect()}
    assert len(rows) == 10
    r0 = rows["0"]
    assert r0.restaurant_name == "Swaad" and r0.restaurant_id == "100"
    assert r0.order_placed_at is not None and r0.order_placed_at_raw == "11:38 PM, September 10 2024"
    assert r0.instructions == 'ring, then say "hi"'
    assert rows["8"].flag_negative_financial is True and rows["8"].rating is None
    assert rows["8"].order_placed_at is None
    assert rows["9"].bill_subtotal is None and rows["9"].review == "multi\nline review"
    audit = {r.column: r for r in pr.numeric_audit(cl.rename_headers(accepted)).collect()}
    assert audit["bill_subtotal"].non_numeric == 1 and audit["total"].negatives == 1


def test_clean_csv_round_trip(spark, raw29, tmp_dir):
    clean = cl.clean_orders(csvio.split_rejects(csvio.read_raw_csv(spark, raw29, multiline=True))[0])
    out = os.path.join(tmp_dir, "clean")
    csvio.write_clean_csv(clean, out)
    assert csvio.read_header(spark, out)[-2:] == ["Order Placed At (raw)", "flag_negative_financial"]
    back = cl.type_orders(csvio.read_staging(spark, out, multiline=True).drop(csvio.CORRUPT))
    a = sorted(map(tuple, clean.collect()))
    b = sorted(map(tuple, back.select(*clean.columns).collect()))
    assert a == b


def test_bad_header(spark, tmp_dir):
    header = [h for h in RAW_HEADERS if h != "Gold discount"] + ["Extra", "Total"]
    path = _write(os.path.join(tmp_dir, "bad_header.csv"), [",".join(_q(h) for h in header)])
    got = {(r.column, r.status) for r in pr.schema_check(spark, csvio.read_header(spark, path), RAW_HEADERS).collect()}
    assert ("Gold discount", "missing") in got and ("Extra", "unexpected") in got and ("Total", "duplicate") in got


def test_quoting_and_short_rows(spark, tmp_dir):
    lines = ["a,b,c", '"he said ""hi"", ok",x\\y,"two\nlines"', ',"",NA', "short,row"]
    path = _write(os.path.join(tmp_dir, "quoting.csv"), lines)
    df = csvio.read_csv(spark, path, __import__("pyspark.sql.types", fromlist=["x"]).StructType.fromJson(
        {"type": "struct", "fields": [{"name": n, "type": "string", "nullable": True, "metadata": {}} for n in "abc"]}), multiline=True)
    accepted, rejected = csvio.split_rejects(df, min_fields=3)
    rows = accepted.collect()
    assert rows[0].a == 'he said "hi", ok' and rows[0].b == "x\\y" and rows[0].c == "two\nlines"
    assert rows[1].a is None and rows[1].c == "NA"
    rej = rejected.collect()
    assert len(rej) == 1 and rej[0].fields == 2


def test_kv_tsv_source(spark, tmp_dir):
    lines = ["1\tSwaad\torder_count=3\ttotal_revenue=10.5\tavg_kpt=bad", "", "   ",
             "Aura\torder_count=2\tavg_rider_wait=1=2", "order_count=9", "7\tX\tavg_kpt=1\tavg_kpt=2"]
    path = _write(os.path.join(tmp_dir, "metrics.tsv"), lines)
    got = {r.restaurant_name: r for r in kv_tsv.read_kv_tsv(spark, path).collect()}
    assert set(got) == {"Swaad", "Aura", "X"}
    assert got["Swaad"].restaurant_id == "1" and got["Swaad"].order_count == 3.0
    assert got["Swaad"].total_revenue == 10.5 and got["Swaad"].avg_kpt is None
    assert got["Aura"].restaurant_id is None and got["Aura"].avg_rider_wait is None
    assert got["X"].avg_kpt == 2.0


def test_plain_tsv_round_trip(spark, tmp_dir):
    perf = spark.createDataFrame([("1", "A", 3, 10.0, 3.333, None, 2.0)],
                                 "restaurant_id string, restaurant_name string, order_count long, total_revenue double, "
                                 "avg_order_value double, avg_kpt double, avg_rider_wait double")
    lines = [r.value for r in kv_tsv.to_tsv_lines(perf).collect()]
    assert lines == ["1\tA\t3\t10.00\t3.33\t\t2.00"]
    out = os.path.join(tmp_dir, "plain")
    kv_tsv.write_tsv(perf, out)
    r = kv_tsv.read_plain_tsv(spark, out).first()
    assert r.order_count == 3 and r.avg_order_value == 3.33 and r.avg_kpt is None


def test_json_report_and_usage(spark, tmp_dir):
    rep = spark.createDataFrame([("SUCCESS", None)], "status string, note string")
    out = os.path.join(tmp_dir, "report")
    reports.write_report_json(rep, out)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".json"))
    assert '"note":null' in text
    usage = reports.usage_total(reports.file_usage(spark, out, glob="*.json")).first()
    assert usage.files == 1 and usage.bytes > 0


def test_typed_table_and_catalog(spark, tmp_dir):
    df = spark.createDataFrame([("1", 2.0)], "restaurant_id string, total double")
    tables.create_database(spark, "food_delivery_test")
    tables.drop_table(spark, "orders_t")
    tables.save_typed(df, table="orders_t", path=os.path.join(tmp_dir, "ext"), fmt="orc")
    names = [r.table for r in tables.list_tables(spark, "food_delivery_test").collect()]
    assert "orders_t" in names
    assert tables.row_count(spark.table("orders_t")).first().rows == 1
    tables.drop_table(spark, "orders_t")
    assert os.path.exists(os.path.join(tmp_dir, "ext"))  # external: files stay
    spark.catalog.setCurrentDatabase("default")
    assert tables.describe(df).count() == 2


def test_record_before_after_and_types(spark, raw29):
    raw = cl.rename_headers(csvio.split_rejects(csvio.read_raw_csv(spark, raw29, multiline=True))[0])
    clean = cl.clean_orders(raw)
    rows = {r.column: r for r in cl.record_before_after(raw, clean, "order_id", "9").collect()}
    assert rows["restaurant_name"].raw_value == " Swaad\t" and rows["restaurant_name"].clean_value == "Swaad"
    assert rows["bill_subtotal"].raw_value == "abc" and rows["bill_subtotal"].clean_value is None
    types = dict((r.column, r.dtype) for r in pr.column_types(clean).collect())
    assert types["total"] == "double" and types["flag_negative_financial"] == "boolean"
    assert "default" in [r.database for r in tables.list_databases(spark).collect()]


def test_distinct_counts_approximate_close_to_exact(spark, raw29):
    raw = cl.rename_headers(csvio.split_rejects(csvio.read_raw_csv(spark, raw29, multiline=True))[0])
    exact = {r.column: r.distinct_values for r in pr.distinct_counts(raw).collect()}
    approx = {r.column: r.distinct_values for r in pr.distinct_counts(raw, approximate=True).collect()}
    assert exact.keys() == approx.keys() and exact["order_id"] == 10
    assert all(abs(exact[c] - approx[c]) <= 1 for c in exact)


def test_from_csv_column_and_typed_schema(spark, raw29):
    from orderlens.schema import ORDERS_TYPED, RAW_29
    lines = spark.createDataFrame([(_raw_row(1),)], "line string")
    parsed = csvio.from_csv_column(lines, "line", RAW_29).select("parsed.*")
    assert parsed.columns == RAW_HEADERS and parsed.first()["Instructions"] == 'ring, then say "hi"'
    clean = cl.clean_orders(csvio.split_rejects(csvio.read_raw_csv(spark, raw29, multiline=True))[0])
    assert [(f.name, f.dataType) for f in clean.schema.fields] == [(f.name, f.dataType) for f in ORDERS_TYPED.fields]


def test_sql_staging_table_equals_reader(spark, raw29, tmp_dir):
    clean = cl.clean_orders(csvio.split_rejects(csvio.read_raw_csv(spark, raw29, multiline=True))[0])
    out = os.path.join(tmp_dir, "clean_for_sql")
    csvio.write_clean_csv(clean, out)
    staged = tables.create_staging_table(spark, "orders_raw_text_t", out, multiline=True)
    via_reader = csvio.read_staging(spark, out, multiline=True).drop(csvio.CORRUPT)
    assert staged.columns == via_reader.columns
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, via_reader.collect()))
    tables.drop_table(spark, "orders_raw_text_t")
    assert any(f.endswith(".csv") for f in os.listdir(out))  # external: files stay
