"""Named queries: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Every query reads the whole driver tables through the order-table mapping
(``sources.fixtures``), landed once per application as a typed Parquet copy
(``plans.landing``, the CTAS step of the original workflow), and runs one
library operator on it.  Computed
columns carry the same names as the DuckDB oracle (``plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import findings as fnd
from orderlens.operators import performance as perf
from orderlens.operators import queries as q
from orderlens.operators import reconcile as rec
from orderlens.operators import scorecard as sc
from orderlens.plans.landing import raw_staging, typed_orders
from orderlens.plans.landing import restaurant_metrics as landed_metrics

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed order table: derived from the driver tables once per
    application and scanned by every query (see ``plans.landing``)."""
    return typed_orders(spark, sf_dir)


def _metrics(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Per-restaurant metrics, aggregated once per application (``plans.landing``)."""
    return landed_metrics(spark, sf_dir, key)


def _card(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return sc.scorecard(_metrics(spark, sf_dir, key), materialized=True)


# --- Q1-Q12 -----------------------------------------------------------------
register("q01_total_orders")(lambda s, d: q.total_orders(_orders(s, d)))
register("q02_orders_by_restaurant")(lambda s, d: q.orders_by_restaurant(_orders(s, d)))
register("q03_orders_by_status")(lambda s, d: q.orders_by_status(_orders(s, d)))
# SUM over doubles is rounded here only so two engines' summation orders agree.
register("q04_revenue_by_restaurant")(lambda s, d: q.revenue_by_restaurant(_orders(s, d), digits=2))
register("q05_avg_order_value")(lambda s, d: q.avg_order_value_by_restaurant(_orders(s, d)))
register("q06_top_orders")(lambda s, d: q.top_orders(_orders(s, d)))
register("q07_kpt_by_restaurant")(lambda s, d: q.kpt_by_restaurant(_orders(s, d)))
register("q08_rider_wait_by_restaurant")(lambda s, d: q.rider_wait_by_restaurant(_orders(s, d)))
register("q09_distance_behaviour")(lambda s, d: q.distance_behaviour(_orders(s, d)))
register("q10_rating_by_restaurant")(lambda s, d: q.rating_by_restaurant(_orders(s, d)))
register("q11_complaint_types")(lambda s, d: q.complaint_types(_orders(s, d)))
register("q12_high_performing")(lambda s, d: q.high_performing_restaurants(_orders(s, d)))
register("q02_orders_by_restaurant_id")(lambda s, d: q.orders_by_restaurant(_orders(s, d), by="restaurant_id"))
register("q12_high_performing_by_id")(
    lambda s, d: q.high_performing_restaurants(_orders(s, d), by="restaurant_id", min_orders=50, min_rating=3.5))

# --- roll-up, scorecard, reports ---------------------------------------------
register("perf_by_restaurant_id")(lambda s, d: perf.restaurant_performance(_orders(s, d), "restaurant_id"))
register("perf_by_restaurant_name")(lambda s, d: perf.restaurant_performance(_orders(s, d), "restaurant_name"))
register("scorecard_by_name")(lambda s, d: _card(s, d, "restaurant_name"))
register("scorecard_by_id")(lambda s, d: _card(s, d, "restaurant_id"))


@register("scorecard_join")
def _scorecard_join(s: SparkSession, d: str) -> DataFrame:
    """Scorecard built the two-source way: roll-up LEFT JOIN rating table."""
    o = _orders(s, d)
    m = perf.combine(perf.restaurant_performance(o, "restaurant_name").drop("restaurant_id"),
                     perf.rating_metrics(o, "restaurant_name"))
    return sc.scorecard(m)


register("revenue_share")(lambda s, d: sc.revenue_share(_metrics(s, d, "restaurant_id"))
                          .select("restaurant_id", "total_revenue", "revenue_share_pct"))
register("efficiency_ratio")(lambda s, d: sc.efficiency_ratio(_metrics(s, d, "restaurant_id"))
                             .select("restaurant_id", "efficiency_ratio"))
register("median_impute")(lambda s, d: _card(s, d, "restaurant_id")
                          .select("restaurant_id", "avg_rating_clean", "avg_kpt_clean", "avg_wait_clean"))
register("bottlenecks")(lambda s, d: sc.bottlenecks(_card(s, d, "restaurant_id")))
register("growth_opportunities")(lambda s, d: sc.growth_opportunities(_card(s, d, "restaurant_id")))


@register("executive_summary")
def _summary(s: SparkSession, d: str) -> DataFrame:
    e = sc.executive_summary(_card(s, d, "restaurant_name"))
    return e.select(
        "total_restaurants", "total_orders",
        F.round("total_platform_revenue", 2).alias("total_platform_revenue"),
        "avg_platform_order_value",
        F.array_join("bottleneck_restaurants", "|").alias("bottleneck_restaurants"),
        F.array_join("growth_opportunity_restaurants", "|").alias("growth_opportunity_restaurants"))


@register("reconcile_metrics")
def _reconcile(s: SparkSession, d: str) -> DataFrame:
    o = _orders(s, d)
    actual = perf.restaurant_performance(o, "restaurant_name")
    return rec.reconcile(actual, rec.expected_metrics(o, "restaurant_name"), "restaurant_name", tolerance=0.01)


register("weighted_vs_unweighted_aov")(lambda s, d: fnd.weighted_vs_unweighted_aov(_card(s, d, "restaurant_id")))
register("kpt_rating_corr")(lambda s, d: fnd.kpt_rating_corr(_card(s, d, "restaurant_id")))
register("top3_ratings")(lambda s, d: fnd.top_ratings(_card(s, d, "restaurant_id"), 3))
register("volume_share")(lambda s, d: fnd.volume_share(_card(s, d, "restaurant_name")))
register("slow_kitchens")(lambda s, d: fnd.slow_kitchens(_card(s, d, "restaurant_id")))
register("extremes")(lambda s, d: fnd.extremes(_card(s, d, "restaurant_id")))


# --- profiling and cleaning of the dirty all-string staging table ------------
from orderlens.operators import clean as cl  # noqa: E402
from orderlens.operators import profile as pr  # noqa: E402
from orderlens.sources import csv as csvio  # noqa: E402
from orderlens.sources import kv_tsv, tables  # noqa: E402
from orderlens.plans.end_to_end import read_artefacts, run_end_to_end, validate  # noqa: E402
from orderlens.session import scratch_path  # noqa: E402


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty staging table, landed once per application like a raw file."""
    return raw_staging(spark, sf_dir)


register("shape")(lambda s, d: pr.shape(_raw(s, d)))
register("missing_report")(lambda s, d: pr.missing_report(_raw(s, d)))
register("missing_rate_by_status")(lambda s, d: pr.missing_rate_by_status(_raw(s, d)))
register("numeric_audit")(lambda s, d: pr.numeric_audit(_raw(s, d)))
register("coercion_failures")(lambda s, d: pr.coercion_failures(cl.strip_strings(_raw(s, d))))
register("rating_out_of_range")(lambda s, d: pr.rating_out_of_range(_raw(s, d)))
register("timestamp_audit")(lambda s, d: pr.timestamp_audit(_raw(s, d)))
register("categorical_top15")(lambda s, d: pr.categorical_top(_raw(s, d), k=15))
register("distinct_counts")(lambda s, d: pr.distinct_counts(_raw(s, d)))
register("text_audit")(lambda s, d: pr.text_audit(_raw(s, d)))
register("strip_strings")(lambda s, d: cl.strip_strings(_raw(s, d)))
register("coerce_numeric")(lambda s, d: cl.coerce_numeric(cl.strip_strings(cl.null_missing_tokens(_raw(s, d))))
                           .select("order_id", *[c for c in cl.NUMERIC]))
register("parse_timestamp")(lambda s, d: cl.parse_timestamp(cl.strip_strings(cl.null_missing_tokens(_raw(s, d))))
                            .select("order_id", "order_placed_at", "order_placed_at_raw"))
register("negative_flag")(lambda s, d: pr.flagged_rows(cl.clean_orders(_raw(s, d))))
register("clean_orders")(lambda s, d: cl.clean_orders(_raw(s, d)))
register("missing_after_clean")(lambda s, d: pr.missing_report(cl.clean_orders(_raw(s, d)), tokens=None, top=15))
register("before_after_diff")(lambda s, d: pr.cleaning_diff(_raw(s, d)))
register("preview_top_n")(lambda s, d: tables.preview(_raw(s, d), 5, order_by="order_id"))
register("reject_empty_keys")(lambda s, d: tables.row_count(cl.reject_empty_keys(cl.clean_orders(_raw(s, d)))))


# --- sources and sinks: write what Spark derives from the tables, read it back --
@register("csv_round_trip")
def _csv_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Clean table -> CSV (31 headers) -> staging read -> typed projection."""
    path = scratch_path(s, "clean_csv")
    csvio.write_clean_csv(cl.clean_orders(_raw(s, d)), path)
    back = csvio.read_staging(s, path).drop(csvio.CORRUPT)
    return cl.type_orders(back)


def _with_line_ends(clean: DataFrame) -> DataFrame:
    """Every third order's instructions with line ends of both kinds, a quote and a comma."""
    noted = F.concat(F.coalesce("instructions", F.lit("")), F.lit('\nring "twice",\r\n\nthen wait'))
    third = F.col("order_id").cast("bigint") % 3 == 0
    return clean.withColumn("instructions", F.when(third, noted).otherwise(F.col("instructions")))


@register("csv_line_ends_round_trip")
def _csv_line_ends(s: SparkSession, d: str) -> DataFrame:
    """Clean table with line ends inside cells -> CSV -> default reader -> typed projection."""
    path = scratch_path(s, "line_ends_csv")
    csvio.write_clean_csv(_with_line_ends(cl.clean_orders(_raw(s, d))), path)
    return cl.type_orders(csvio.read_staging(s, path).drop(csvio.CORRUPT))


@register("typed_orders_orc")
def _typed_orc(s: SparkSession, d: str) -> DataFrame:
    path = scratch_path(s, "orders_orc")
    tables.save_typed(cl.clean_orders(_raw(s, d)), path=path, fmt="orc")
    return tables.read_typed(s, path, "orc")


@register("kv_tsv_source")
def _kv_tsv(s: SparkSession, d: str) -> DataFrame:
    path = scratch_path(s, "perf_kv_tsv")
    kv_tsv.write_tsv(perf.restaurant_performance(_orders(s, d), "restaurant_id"), path, style="kv")
    return kv_tsv.read_kv_tsv(s, path)


@register("plain_tsv_source")
def _plain_tsv(s: SparkSession, d: str) -> DataFrame:
    path = scratch_path(s, "perf_tsv")
    kv_tsv.write_tsv(perf.restaurant_performance(_orders(s, d), "restaurant_id"), path, style="plain")
    return kv_tsv.read_plain_tsv(s, path)


SHORT_ROW_EVERY = 37  # every 37th order is written with only its first 20 fields


@register("reject_short_rows")
def _reject_short_rows(s: SparkSession, d: str) -> DataFrame:
    """Raw text with a header line and truncated records -> every record's fate, in one pass."""
    raw = _raw(s, d)
    opts = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    full = F.to_csv(F.struct(*raw.columns), opts)
    short = F.to_csv(F.struct(*raw.columns[:20]), opts)
    cut = (F.col("order_id").cast("bigint") % SHORT_ROW_EVERY) == 0
    lines = raw.select(F.when(cut, short).otherwise(full).alias("value"))
    header = s.createDataFrame([(",".join(raw.columns),)], "value string")
    path = scratch_path(s, "raw_text")
    header.unionByName(lines).write.mode("overwrite").text(path)
    df = csvio.read_csv(s, path, _raw_schema(raw), header=False)
    df = csvio.skip_header_rows(df, raw.columns)
    _, rejected = csvio.split_rejects(df, min_fields=26)
    return rejected.select("first_field", "fields")


def _raw_schema(raw: DataFrame):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(c, T.StringType(), True) for c in raw.columns])


@register("scorecard_from_files")
def _scorecard_from_files(s: SparkSession, d: str) -> DataFrame:
    """Roll-up TSV and Q10 CSV written, read back, joined and scored."""
    return sc.scorecard(_artefacts(s, d))


@register("validation_report")
def _validation_report(s: SparkSession, d: str) -> DataFrame:
    """The report's status and entries for the artefacts against the order table."""
    report = validate(s, _artefacts(s, d), _orders(s, d), tolerance=0.01)
    return report.select("status", F.explode("metrics_validation").alias("e")).select("status", "e.*")


def _artefacts(s: SparkSession, d: str) -> DataFrame:
    o = _orders(s, d)
    tsv, ratings = scratch_path(s, "rollup_tsv"), scratch_path(s, "q10_csv")
    kv_tsv.write_tsv(perf.restaurant_performance(o, "restaurant_name"), tsv, style="kv")
    csvio.write_csv(q.with_title(q.rating_by_restaurant(o), q.TITLES["q10"]), ratings)
    return read_artefacts(s, tsv, ratings)


from orderlens.operators import results as res  # noqa: E402
from orderlens.operators import profile_state as ps  # noqa: E402
from orderlens.operators import reconcile_rows as rr  # noqa: E402
from orderlens.schema import CLEAN_EXTRA_HEADERS, RAW_HEADERS  # noqa: E402
from orderlens.sources import store  # noqa: E402

@register("perf_from_buckets")
def _perf_from_buckets(s: SparkSession, d: str) -> DataFrame:
    """Typed table -> bucketed table -> roll-up that exchanges partial rows only."""
    path = scratch_path(s, "orders_bucketed")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    store.save_bucketed(_orders(s, d), name, path=path, buckets=16)
    return perf.restaurant_performance(s.table(name), "restaurant_id", within=(store.SALT,))


@register("orders_by_month")
def _orders_by_month(s: SparkSession, d: str) -> DataFrame:
    """Table by month, its first half year ingested twice more -> orders and revenue of each month."""
    path, orders = scratch_path(s, "orders_by_month"), _orders(s, d)
    store.ingest_days(orders, path, grain="month")
    for _ in range(2):
        store.ingest_days(orders.where("order_placed_at < TIMESTAMP_NTZ '1992-07-01'"), path, grain="month")
    return (store.read_days(s, path).groupBy(store.DAY)
            .agg(F.count(F.lit(1)).alias("order_count"), F.round(F.sum("total"), 2).alias("total_revenue")))


@register("profile_merged")
def _profile_merged(s: SparkSession, d: str) -> DataFrame:
    """States by year, kept and read back, merged; the estimate of distinct values tested against the exact number."""
    raw, path = _raw(s, d), scratch_path(s, "profile_states")
    ps.save_states(ps.column_states(raw, grain="year"), path)
    merged = ps.merged_profile(ps.read_states(s, path)).join(
        pr.distinct_counts(raw).withColumnRenamed("distinct_values", "exact"), "column")
    off = F.abs(F.col("distinct_values") - F.col("exact"))
    return merged.withColumn("distinct_within", off <= F.lit(5 * ps.standard_error()) * F.col("exact")).drop("distinct_values", "exact")


@register("categorical_top_merged")
def _categorical_top_merged(s: SparkSession, d: str) -> DataFrame:
    path = scratch_path(s, "value_states")
    ps.save_states(ps.value_states(_raw(s, d), grain="year"), path)
    return ps.merged_top(ps.read_states(s, path), k=15)


@register("reconcile_rows")
def _reconcile_rows(s: SparkSession, d: str) -> DataFrame:
    """The order table against a copy from which orders are missing, changed and repeated."""
    left = _orders(s, d)
    number = F.col("order_id").cast("bigint")
    changed = F.when(number % 89 == 0, F.coalesce("total", F.lit(0.0)) + 1).otherwise(F.col("total"))
    right = left.where(number % 97 != 0).withColumn("total", changed)
    return rr.reconcile_rows(left, right.unionByName(right.where(number % 101 == 0)))


@register("schema_check")
def _schema_check(s: SparkSession, d: str) -> DataFrame:
    """Clean CSV in two folders, one with a renamed and a further column; every file's header checked."""
    path, clean = scratch_path(s, "headers_csv"), cl.clean_orders(_raw(s, d))
    csvio.write_clean_csv(clean, f"{path}/good")
    bad = cl.to_headers(clean).withColumnRenamed("Gold discount", "Gold rebate").withColumn("Extra", F.lit("x"))
    csvio.write_csv(bad, f"{path}/bad")
    found = pr.schema_check_by_file(csvio.file_headers(s, [f"{path}/good", f"{path}/bad"]), RAW_HEADERS + CLEAN_EXTRA_HEADERS)
    folder = F.regexp_extract("file", "/([^/]+)/[^/]+$", 1)
    return found.where("status <> 'ok'").select(folder.alias("folder"), "column", "status").distinct()


register("all_results")(lambda s, d: res.all_results(_orders(s, d), digits=2))


register("summary_names")(lambda s, d: sc.summary_names(_card(s, d, "restaurant_name")))
register("validation_status")(lambda s, d: rec.validation_status(_reconcile(s, d)))


@register("end_to_end_scorecard")
def _end_to_end(s: SparkSession, d: str) -> DataFrame:
    """Every stage on the dirty table, all artefacts written; the scorecard file read back."""
    out = run_end_to_end(s, _raw(s, d), scratch_path(s, "end_to_end"), tolerance=0.01, reports_as_rows=True)
    return csvio.read_csv(s, out["scorecard"], _card(s, d, "restaurant_name").schema, keep_corrupt=False, multiline=False)


# --- remaining report shapes ----------------------------------------------------
register("q01_with_title")(lambda s, d: q.with_title(q.total_orders(_orders(s, d)), q.TITLES["q01"]))
register("timestamp_samples")(lambda s, d: pr.timestamp_samples(_raw(s, d), n=10))


@register("top3_volume_share")
def _top3_share(s: SparkSession, d: str) -> DataFrame:
    card = _card(s, d, "restaurant_id")
    return fnd.group_volume_share(card, fnd.top_ratings(card, 3))
