"""The whole workflow as one Spark application.

raw CSV -> ONE parse into a written columnar staging table that keeps the text
of irregular records -> rejects, clean CSV and typed table, all from that copy
-> twelve query results from one grouped scan and a top-k -> per-restaurant roll-up (``key=value`` TSV) and rating
CSV (Q10) -> both files read back, joined into the scorecard (CSV), compared
with the validator's own recomputation -> validation report and executive
summary (JSON).

The report's status is SUCCESS or MISMATCH; SKIPPED_NO_CLEAN_DATA if the clean
table is empty or not there; ERROR with the reason if the comparison fails.  ``raw`` may be
any path, or several; line ends inside quotes are found by file (``sources.csv``).
"""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, ArithmeticException, SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators import clean as cl
from orderlens.operators import performance as perf
from orderlens.operators import queries as q
from orderlens.operators import reconcile as rec
from orderlens.operators import results as res
from orderlens.operators import scorecard as sc
from orderlens.plans.materialize import discard, materialize
from orderlens.sources import csv as csvio
from orderlens.sources import kv_tsv, paths, reports, tables

# Q10 as a titled CSV: title, name, mean rating, number of ratings.
RATING_SCHEMA = T.StructType([
    T.StructField("query_title", T.StringType()), T.StructField("restaurant_name", T.StringType()),
    T.StructField("avg_rating", T.DoubleType()), T.StructField("num_ratings", T.LongType())])


def parse_once(spark: SparkSession, raw: str | list[str], multiline: bool | None = None) -> DataFrame:
    """The raw text parsed by one job into a written staging table with ``_corrupt_record``."""
    return materialize(csvio.read_raw_csv(spark, raw, multiline=multiline), "raw_staging")


def read_artefacts(spark: SparkSession, rollup_tsv: str, ratings_csv: str) -> DataFrame:
    """Roll-up text LEFT JOIN rating CSV on the restaurant's name, as metrics rows."""
    ratings = csvio.read_csv(spark, ratings_csv, RATING_SCHEMA, keep_corrupt=False)
    rollup = kv_tsv.read_kv_tsv(spark, rollup_tsv).withColumn("order_count", F.col("order_count").cast("bigint"))
    return perf.combine(rollup.drop("restaurant_id"), ratings, "restaurant_name")


def validate(spark: SparkSession, metrics: DataFrame, clean: DataFrame, tolerance: float | None = None) -> DataFrame:
    """The validation report of metrics read from the artefacts against the clean table."""
    try:
        if clean.isEmpty():
            return rec.skipped_report(spark)
        return materialize(rec.validation_report(
            rec.reconcile(metrics, rec.expected_metrics(clean), tolerance=tolerance)), "validation")
    except (AnalysisException, SparkRuntimeException, ArithmeticException) as e:
        return rec.error_report(spark, e)


def validate_paths(spark: SparkSession, rollup_tsv: str | list[str], ratings_csv: str | list[str], clean: str | list[str],
                   fmt: str = "orc", tolerance: float | None = None) -> DataFrame:
    """The validation report of artefacts where they lie; each may be a path or several, the first that exists is read.

    SKIPPED_NO_CLEAN_DATA if no clean table is there (or it is empty), ERROR with the reason if the artefacts or the
    table cannot be read or compared, else SUCCESS or MISMATCH."""
    listed = lambda p: [p] if isinstance(p, str) else list(p)
    table = paths.first_existing(spark, *listed(clean))
    if table is None:
        return rec.skipped_report(spark)
    try:
        metrics = read_artefacts(spark, paths.resolve(spark, *listed(rollup_tsv)), paths.resolve(spark, *listed(ratings_csv)))
        orders = csvio.read_staging(spark, table).drop(csvio.CORRUPT) if fmt == "csv" else tables.read_typed(spark, table, fmt)
        return validate(spark, metrics, cl.type_orders(orders) if fmt == "csv" else orders, tolerance)
    except (FileNotFoundError, AnalysisException) as e:
        return rec.error_report(spark, e)
    except Py4JJavaError as e:  # a file that is not what its name says
        return rec.error_report(spark, RuntimeError(e.java_exception.getMessage()))


def run_end_to_end(spark: SparkSession, raw: str | list[str] | DataFrame, out_dir: str, fmt: str = "orc",
                   min_fields: int = 26, tolerance: float | None = None, multiline: bool | None = None,
                   reports_as_rows: bool = False) -> dict[str, str]:
    """Run every stage; return the output path of each stage.

    The two reports are documents that hold all restaurants in arrays; with ``reports_as_rows`` each is one row of
    figures, and its restaurants are rows of ``validation_entries`` and ``summary_names``, for any number of them."""
    out = {k: os.path.join(out_dir, k) for k in
           ("rejects", "clean_csv", "orders_typed", "queries", "rollup_tsv", "scorecard", "validation", "summary")}
    if isinstance(raw, DataFrame):
        accepted = raw
    else:
        accepted, rejected = csvio.split_rejects(parse_once(spark, raw, multiline), min_fields)
        rejected.write.mode("overwrite").json(out["rejects"])
    tables.save_typed(cl.clean_orders(accepted), path=out["orders_typed"], fmt=fmt)
    orders = tables.read_typed(spark, out["orders_typed"], fmt)
    csvio.write_clean_csv(orders, out["clean_csv"])

    results = materialize(res.all_results(orders), "results")
    for name, title in q.TITLES.items():
        csvio.write_csv(q.with_title(res.result_of(results, name), title), os.path.join(out["queries"], name))
    discard(results)

    kv_tsv.write_tsv(perf.restaurant_performance(orders, "restaurant_name"), out["rollup_tsv"], style="kv")
    metrics = read_artefacts(spark, out["rollup_tsv"], os.path.join(out["queries"], "q10"))
    card = materialize(sc.scorecard(metrics), "scorecard")
    csvio.write_csv(card, out["scorecard"])
    if not reports_as_rows:
        reports.write_report_json(validate(spark, metrics, orders, tolerance), out["validation"])
        reports.write_report_json(sc.executive_summary(card), out["summary"])
        return out
    out |= {k: os.path.join(out_dir, k) for k in ("validation_entries", "summary_names")}
    compared = materialize(rec.reconcile(metrics, rec.expected_metrics(orders), tolerance=tolerance), "validation")
    reports.write_report_json(rec.validation_status(compared), out["validation"])
    reports.write_report_json(sc.summary_totals(card), out["summary"])
    compared.write.mode("overwrite").option("ignoreNullFields", False).json(out["validation_entries"])
    sc.summary_names(card).write.mode("overwrite").json(out["summary_names"])
    return out
