"""Line ends inside quoted cells: files are split as before, records come back whole."""

import os
import random

import pytest

from orderlens.operators import clean as cl
from orderlens.schema import RAW_29, RAW_HEADERS
from orderlens.sources import csv as csvio
from orderlens.sources.csv_records import files_with_line_ends, records

CELLS = ["", "a", "x,y", 'say "hi"', "two\nlines", "three\n\nlines\n", 'quote"\n"end', ",\n,", "\r\n", '"', '""', " lead", "a\rb",
         "é🙂\n", "1,\"\n2", "plain", "plain", "plain", '5" pizza']


def quoted(cell):
    return '"' + cell.replace('"', '""') + '"' if cell == "" or any(c in cell for c in ',"\n\r') else cell


def put(path, rows, header="a,b,c", end="\n", last=True):
    text = end.join([header, *(",".join(map(quoted, r)) for r in rows)]) + (end if last else "")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def schema(names="abc"):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def rows_of(df, names="abc"):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_across_splits(spark, small_splits, tmp_dir, end):
    rng = random.Random(len(end))
    expected, plain = [], []
    for k in range(3):
        rows = [tuple(rng.choices(CELLS, k=3)) for _ in range(120)] + [("start", "z\n" * 400, "spans several splits")]
        put(f"{tmp_dir}/in dir/{k}.csv", rows, end=end, last=k != 1)
        expected += rows
    flat = [("p", str(i), "q,r") for i in range(200)]
    put(f"{tmp_dir}/in dir/flat.csv", flat, end=end)
    broken, whole = files_with_line_ends(spark, f"{tmp_dir}/in dir")
    assert len(broken) == 3 and [os.path.basename(f) for f in whole] == ["flat.csv"]
    df = csvio.read_csv(spark, f"{tmp_dir}/in dir", schema())
    assert rows_of(df) == sorted(expected + flat)
    assert all(r["_corrupt_record"] is None for r in df.collect())
    assert spark.read.text(broken).rdd.getNumPartitions() > 6  # they are split


def test_five_orders_stay_five(spark, tmp_dir):
    rows = [[f"r{k}" if i == 0 else str(k) if i == 4 else "x" for i in range(29)] for k in range(5)]
    rows[2][10] = "ring\ntwice"
    put(f"{tmp_dir}/raw/orders.csv", rows, header=",".join(quoted(h) for h in RAW_HEADERS))
    accepted, rejected = csvio.split_rejects(csvio.read_raw_csv(spark, f"{tmp_dir}/raw"))
    assert rejected.count() == 0 and accepted.count() == 5
    clean = cl.clean_orders(accepted)
    assert sorted(r.instructions for r in clean.collect() if r.order_id == "2") == ["ring\ntwice"]
    csvio.write_clean_csv(clean, f"{tmp_dir}/clean")
    back = cl.type_orders(csvio.read_staging(spark, f"{tmp_dir}/clean").drop(csvio.CORRUPT))
    assert sorted(map(tuple, back.select(*clean.columns).collect())) == sorted(map(tuple, clean.collect()))


def test_short_records_with_line_ends_are_one_reject(spark, tmp_dir):
    put(f"{tmp_dir}/s/a.csv", [("1", "two\nlines"), ("1", "2", "3"), ("1", "2", "3", "4")])
    accepted, rejected = csvio.split_rejects(csvio.read_csv(spark, f"{tmp_dir}/s", schema()), min_fields=3)
    assert [(r.first_field, r.record, r.fields) for r in rejected.collect()] == [("1", '1,"two\nlines"', 2)]
    assert rows_of(accepted) == [("1", "2", "3")] * 2


def test_files_without_line_ends_go_to_the_split_reader(spark, small_splits, tmp_dir):
    put(f"{tmp_dir}/f/a.csv", [("1", 'a "b" c', "x,y")] * 100)
    df = csvio.read_csv(spark, f"{tmp_dir}/f", schema())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "Exchange" not in plan and df.rdd.getNumPartitions() > 3


def test_a_quote_never_closed_keeps_its_lines(spark, small_splits, tmp_dir):
    put(f"{tmp_dir}/q/a.csv", [("1", "a\nb", "2")])
    with open(f"{tmp_dir}/q/a.csv", "a") as f:
        f.write('x,"never closed,1\n' + "4,5,6\n" * 150)
    got = [r.record for r in records(spark, f"{tmp_dir}/q").collect()]
    assert sorted(got) == sorted(['1,"a\nb",2', 'x,"never closed,1', *["4,5,6"] * 150])


def test_blank_lines_headers_and_empty_files(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/b")
    for name, text in (("a", '\n\na,"b\nb",c\n\n1,"2\n\n2",3\n   \n4,5,6'), ("b", ""), ("c", "a,b,c\n")):
        with open(f"{tmp_dir}/b/{name}.csv", "w") as f:
            f.write(text)
    assert rows_of(csvio.read_csv(spark, f"{tmp_dir}/b", schema())) == [("1", "2\n\n2", "3"), ("4", "5", "6")]
    kept = csvio.read_csv(spark, f"{tmp_dir}/b", schema(), header=False)
    assert rows_of(kept) == sorted([("a", "b\nb", "c"), ("1", "2\n\n2", "3"), ("4", "5", "6"), ("a", "b", "c")])


def test_typed_schema_and_long_cells(spark, tmp_dir):
    from pyspark.sql import types as T
    put(f"{tmp_dir}/t/a.csv", [("1", "2.5", "x\n" * 600_000), ("bad", "1", "y")])
    typed = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])
    got = csvio.read_csv(spark, f"{tmp_dir}/t", typed).collect()
    by = {r.b: r for r in got}
    assert by[2.5].a == 1 and len(by[2.5].c) == 1_200_000 and by[1.0].a is None and by[1.0]["_corrupt_record"] == "bad,1,y"
    assert len(RAW_29.fields) == 29


def test_staging_table_and_stream_keep_line_ends(spark, tmp_dir):
    from orderlens.sources import tables
    from orderlens.streaming.ingest import start_ingest
    rows = [[f"r{k}" if i == 0 else str(k) if i == 4 else "x" for i in range(29)] for k in range(4)]
    rows[1][10] = "one\ntwo"
    put(f"{tmp_dir}/raw/orders.csv", rows, header=",".join(quoted(h) for h in RAW_HEADERS))
    staged = tables.create_staging_table(spark, "line_ends_t", f"{tmp_dir}/raw", RAW_29)
    assert staged.count() == 4
    tables.drop_table(spark, "line_ends_t")
    start_ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination(120)
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert got.count() == 4 and got.where("order_id = '1'").first().instructions == "one\ntwo"


@pytest.mark.parametrize("size", ["9000b", "128m"])
def test_text_is_neither_windowed_nor_sorted(spark, tmp_dir, monkeypatch, size):
    """Windows see a row for 64 lines, and records over the bounds of chunks and splits are those of the whole-file reader."""
    from orderlens.sources import csv_records
    rng = random.Random(7)
    for k in range(3):
        put(f"{tmp_dir}/c/{k}.csv", [tuple(rng.choices([*CELLS, "\n" * rng.randint(50, 200)], weights=[9] * len(CELLS) + [1], k=3))
                                     for _ in range(700)], header="\n" * (70 * k) + "a,b,c")
    written = {}

    def keep(df, name):
        written[name] = df._jdf.queryExecution().optimizedPlan().toString(), (copy := materialize(df, name))
        return copy

    materialize = csv_records.materialize
    monkeypatch.setattr(csv_records, "materialize", keep)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        found = records(spark, f"{tmp_dir}/c", header=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = rows_of(csvio.read_csv(spark, f"{tmp_dir}/c", schema()))
        lines = written["csv_lines"][1]
        assert "Window" not in written["csv_lines"][0] and "Sort" not in plan.replace("SortAggregate", "")
        assert all("value" not in copy.columns for name, (_, copy) in written.items() if name != "csv_lines")
        files = lines.select("file", "block").distinct().count()
        assert max(copy.count() for name, (_, copy) in written.items() if name != "csv_lines") <= lines.count() / 64 + 2 * files
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = csvio.read_csv(spark, f"{tmp_dir}/c", schema(), multiline=True)
    assert got == rows_of(whole) and len(got) > 2000
