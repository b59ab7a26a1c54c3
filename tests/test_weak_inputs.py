"""Timestamp layouts, names in tab-separated text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.functions.expr import DEFAULT_TS_FORMATS, OFFSET_TS_FORMATS, layout_shape, to_ts
from orderlens.sources import kv_tsv

TIMES = {
    "Sep 1 2024": dt.datetime(2024, 9, 1), "Sept 10, 2024": dt.datetime(2024, 9, 10), "September 10, 2024 9:05": dt.datetime(2024, 9, 10, 9, 5),
    "2024/09/10 10:00": dt.datetime(2024, 9, 10, 10), "2024/9/1": dt.datetime(2024, 9, 1), "10-09-2024 09:05 PM": dt.datetime(2024, 9, 10, 21, 5),
    "2024-09-10T10:00:00+0530": dt.datetime(2024, 9, 10, 4, 30), "2024-09-10 10:00:00+05:30": dt.datetime(2024, 9, 10, 4, 30),
    "2024-09-10T10:00:00Z": dt.datetime(2024, 9, 10, 10), "20240910": dt.datetime(2024, 9, 10),
    "2024-09-10 10:00:00.1234567": dt.datetime(2024, 9, 10, 10, 0, 0, 123456), "2024-09-10 10:00:00.5": dt.datetime(2024, 9, 10, 10, 0, 0, 500000),
    "11:38 PM, September 10 2024": dt.datetime(2024, 9, 10, 23, 38), "10-09-2024 21:05": dt.datetime(2024, 9, 10, 21, 5),
    "9/10/2024 21:05": dt.datetime(2024, 9, 10, 21, 5), "2024-09-10": dt.datetime(2024, 9, 10), "2024-9-1 7:05": dt.datetime(2024, 9, 1, 7, 5),
    "20241301": None, "2024-13-01": None, "Sept": None, "": None, "Foo 1 2024": None, "2024-09-10 10:00:00 x": None, "123456789": None, None: None,
}


def test_layouts(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string").select("t", to_ts("t").alias("at"))
    assert {r.t: r.at for r in df.collect()} == TIMES


@pytest.mark.parametrize("fmt", [*DEFAULT_TS_FORMATS, "d.M.yyyy H:mm", "EEE yyyy"])
def test_a_layouts_own_text_has_its_shape(spark, fmt):
    row = spark.sql("SELECT TIMESTAMP '2024-09-07 08:05:09.123456' AS t")
    text = row.select(F.date_format("t", fmt.replace("[", "").replace("]", ""))).first()[0]
    shape = layout_shape(fmt)
    if shape is None:
        assert "EEE" in fmt
        assert spark.createDataFrame([(text,)], "t string").select(to_ts("t", [fmt])).count() == 1
    else:
        assert spark.createDataFrame([(text,)], "t string").select(F.col("t").rlike(shape)).first()[0]
    assert all(layout_shape(f) for f in OFFSET_TS_FORMATS)


NAMES = ["A\tB", "line\nend", "cr\rlf\r\n.", "a=b", "back\\slash", "\\t", "\\\\t", "\\e=\\", "plain", "é\\n"]


@pytest.mark.parametrize("style", ["plain", "kv"])
def test_names_with_tabs_line_ends_and_equals_signs_come_back(spark, tmp_dir, style):
    rows = [(f"{i}\t{n}", n, i, 1.5, 2.0, None, 3.0) for i, n in enumerate(NAMES)]
    perf = spark.createDataFrame(rows, "restaurant_id string, restaurant_name string, order_count long, total_revenue double, "
                                       "avg_order_value double, avg_kpt double, avg_rider_wait double")
    kv_tsv.write_tsv(perf, f"{tmp_dir}/t", style)
    back = (kv_tsv.read_plain_tsv if style == "plain" else kv_tsv.read_kv_tsv)(spark, f"{tmp_dir}/t")
    assert sorted((r.restaurant_id, r.restaurant_name, int(r.order_count), r.total_revenue) for r in back.collect()) == \
        sorted((r[0], r[1], r[2], r[3]) for r in rows)
    foreign = spark.createDataFrame([("1\tC:\\dir\\x\t3\t1.00\t1.00\t\t",)], "value string")
    foreign.write.text(f"{tmp_dir}/f")
    assert kv_tsv.read_plain_tsv(spark, f"{tmp_dir}/f").first().restaurant_name == "C:\\dir\\x"
