"""DuckDB SQL oracles for the registered queries.

The oracle sees only the driver's base views, so every statement inlines the
order-table mapping as a CTE (the same SQL text the Spark side selects).
DuckDB dialect notes: ``regexp_replace`` needs the 'g' flag; ``SUM(bigint)``
is HUGEINT (cast back); integer-times-decimal literals stay decimal (cast to
DOUBLE first).
"""

from __future__ import annotations

from orderlens.sources.fixtures import FOOD_ORDERS_MAPPING, FOOD_ORDERS_RAW_MAPPING, mapping_sql

FO = f"fo AS (\n{mapping_sql(FOOD_ORDERS_MAPPING)}\n)"
RAW = f"raw AS (\n{mapping_sql(FOOD_ORDERS_RAW_MAPPING)}\n)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _keyed(key: str) -> str:
    name = strip("restaurant_name") if key == "restaurant_id" else "restaurant_name"
    return (f"k AS (SELECT {strip(key)} AS {key}, "
            + (f"{name} AS restaurant_name, " if key == "restaurant_id" else "")
            + "total, kpt_duration_minutes AS kpt, rider_wait_time_minutes AS wait, rating FROM fo)")


def _metrics(key: str, ratings: bool = True) -> str:
    rev = "COALESCE(SUM(CASE WHEN isfinite(total) THEN total END), 0)"
    cols = [key]
    if key == "restaurant_id":
        cols.append("MAX(restaurant_name) AS restaurant_name")
    cols += [
        "COUNT(*) AS order_count",
        f"ROUND({rev}, 2) AS total_revenue",
        f"ROUND({rev} / COUNT(*), 2) AS avg_order_value",
        "ROUND(AVG(CASE WHEN isfinite(kpt) AND kpt >= 0 THEN kpt END), 2) AS avg_kpt",
        "ROUND(AVG(CASE WHEN isfinite(wait) AND wait >= 0 THEN wait END), 2) AS avg_rider_wait",
    ]
    if ratings:
        cols += ["ROUND(AVG(rating), 2) AS avg_rating",
                 "CASE WHEN COUNT(rating) > 0 THEN COUNT(rating) END AS num_ratings"]
    return f"m AS (SELECT {', '.join(cols)} FROM k WHERE length({key}) > 0 GROUP BY {key})"


def _card_ctes(key: str) -> str:
    return ",\n".join([
        FO, _keyed(key), _metrics(key),
        "s1 AS (SELECT SUM(total_revenue) AS tr, median(avg_rating) AS mr, median(avg_kpt) AS mk, "
        "median(avg_rider_wait) AS mw FROM m)",
        "c AS (SELECT m.*, ROUND(total_revenue / tr * 100, 2) AS revenue_share_pct, "
        "ROUND(total_revenue / (avg_kpt * order_count), 2) AS efficiency_ratio, "
        "COALESCE(avg_rating, mr) AS avg_rating_clean, COALESCE(avg_kpt, mk) AS avg_kpt_clean, "
        "COALESCE(avg_rider_wait, mw) AS avg_wait_clean FROM m CROSS JOIN s1)",
        "s2 AS (SELECT median(avg_kpt_clean) AS mk2, median(avg_wait_clean) AS mw2, "
        "median(avg_rating_clean) AS mr2, median(order_count) AS mc2 FROM c)",
        "card AS (SELECT c.*, COALESCE(avg_kpt_clean > mk2, false) AS kpt_flag, COALESCE(avg_wait_clean > mw2, false) AS wait_flag, "
        "COALESCE(avg_kpt_clean > mk2 AND avg_wait_clean > mw2, false) AS bottleneck, "
        "COALESCE(avg_rating_clean >= mr2 AND order_count < mc2, false) AS growth_opportunity FROM c CROSS JOIN s2)",
    ])


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


CARD_COLS = ("order_count, total_revenue, avg_order_value, avg_kpt, avg_rider_wait, restaurant_name, "
             "avg_rating, num_ratings, revenue_share_pct, efficiency_ratio, avg_rating_clean, "
             "avg_kpt_clean, avg_wait_clean, kpt_flag, wait_flag, bottleneck, growth_opportunity")

ORACLE: dict[str, str] = {}

# --- Q1-Q12 -----------------------------------------------------------------
ORACLE["q01_total_orders"] = _with(FO, "SELECT COUNT(*) AS total_orders FROM fo")
ORACLE["q02_orders_by_restaurant"] = _with(FO, "SELECT restaurant_name, COUNT(*) AS order_count FROM fo GROUP BY restaurant_name")
ORACLE["q02_orders_by_restaurant_id"] = _with(FO, "SELECT restaurant_id, COUNT(*) AS order_count FROM fo GROUP BY restaurant_id")
ORACLE["q03_orders_by_status"] = _with(FO, "SELECT order_status, COUNT(*) AS cnt FROM fo GROUP BY order_status")
ORACLE["q04_revenue_by_restaurant"] = _with(FO, "SELECT restaurant_name, ROUND(SUM(total), 2) AS total_revenue FROM fo "
                                            "WHERE order_status = 'Delivered' GROUP BY restaurant_name")
ORACLE["q05_avg_order_value"] = _with(FO, "SELECT restaurant_name, ROUND(AVG(total), 2) AS avg_order_value FROM fo "
                                      "WHERE order_status = 'Delivered' GROUP BY restaurant_name")
ORACLE["q06_top_orders"] = _with(FO, "SELECT order_id, restaurant_name, total FROM fo WHERE order_status = 'Delivered' "
                                 "ORDER BY total DESC NULLS LAST, order_id LIMIT 10")
ORACLE["q07_kpt_by_restaurant"] = _with(FO, "SELECT restaurant_name, ROUND(AVG(kpt_duration_minutes), 2) AS avg_kpt, "
                                        "MAX(kpt_duration_minutes) AS max_kpt, MIN(kpt_duration_minutes) AS min_kpt FROM fo "
                                        "WHERE kpt_duration_minutes IS NOT NULL GROUP BY restaurant_name")
ORACLE["q08_rider_wait_by_restaurant"] = _with(FO, "SELECT restaurant_name, ROUND(AVG(rider_wait_time_minutes), 2) AS avg_rider_wait "
                                               "FROM fo WHERE rider_wait_time_minutes IS NOT NULL GROUP BY restaurant_name")
ORACLE["q09_distance_behaviour"] = _with(FO, "SELECT distance, COUNT(*) AS order_count, ROUND(AVG(total), 2) AS avg_order_value "
                                         "FROM fo GROUP BY distance")
ORACLE["q10_rating_by_restaurant"] = _with(FO, "SELECT restaurant_name, ROUND(AVG(rating), 2) AS avg_rating, "
                                           "COUNT(rating) AS num_ratings FROM fo WHERE rating IS NOT NULL GROUP BY restaurant_name")
ORACLE["q11_complaint_types"] = _with(FO, "SELECT customer_complaint_tag, COUNT(*) AS complaint_count FROM fo "
                                      "WHERE customer_complaint_tag IS NOT NULL AND customer_complaint_tag <> '' "
                                      "GROUP BY customer_complaint_tag")
_Q12 = ("SELECT {k}, COUNT(*) AS order_count, ROUND(AVG(rating), 2) AS avg_rating, "
        "ROUND(AVG(kpt_duration_minutes), 2) AS avg_kpt FROM fo WHERE order_status = 'Delivered' "
        "GROUP BY {k} HAVING COUNT(*) > {n} AND AVG(rating) >= {r}")
ORACLE["q12_high_performing"] = _with(FO, _Q12.format(k="restaurant_name", n=500, r=4.0))
ORACLE["q12_high_performing_by_id"] = _with(FO, _Q12.format(k="restaurant_id", n=50, r=3.5))

# --- roll-up, scorecard, reports ---------------------------------------------
ORACLE["perf_by_restaurant_id"] = _with(",\n".join([FO, _keyed("restaurant_id"), _metrics("restaurant_id", False)]),
                                        "SELECT * FROM m")
ORACLE["perf_by_restaurant_name"] = _with(",\n".join([FO, _keyed("restaurant_name"), _metrics("restaurant_name", False)]),
                                          "SELECT * FROM m")
ORACLE["scorecard_by_name"] = _with(_card_ctes("restaurant_name"), f"SELECT {CARD_COLS} FROM card")
ORACLE["scorecard_by_id"] = _with(_card_ctes("restaurant_id"), f"SELECT restaurant_id, {CARD_COLS} FROM card")
ORACLE["scorecard_join"] = ORACLE["scorecard_by_name"]
ORACLE["revenue_share"] = _with(_card_ctes("restaurant_id"), "SELECT restaurant_id, total_revenue, revenue_share_pct FROM card")
ORACLE["efficiency_ratio"] = _with(_card_ctes("restaurant_id"), "SELECT restaurant_id, efficiency_ratio FROM card")
ORACLE["median_impute"] = _with(_card_ctes("restaurant_id"),
                                "SELECT restaurant_id, avg_rating_clean, avg_kpt_clean, avg_wait_clean FROM card")
ORACLE["bottlenecks"] = _with(_card_ctes("restaurant_id"),
                              "SELECT restaurant_id, restaurant_name, order_count, avg_kpt, avg_rider_wait, avg_rating "
                              "FROM card WHERE bottleneck")
ORACLE["growth_opportunities"] = _with(_card_ctes("restaurant_id"),
                                       "SELECT restaurant_id, restaurant_name, order_count, revenue_share_pct, avg_rating, "
                                       "avg_order_value FROM card WHERE growth_opportunity")
ORACLE["executive_summary"] = _with(
    _card_ctes("restaurant_name"),
    "SELECT COUNT(*) AS total_restaurants, CAST(SUM(order_count) AS BIGINT) AS total_orders, "
    "ROUND(SUM(total_revenue), 2) AS total_platform_revenue, "
    "ROUND(SUM(total_revenue) / SUM(order_count), 2) AS avg_platform_order_value, "
    "COALESCE(string_agg(CASE WHEN bottleneck THEN restaurant_name END, '|' ORDER BY restaurant_name), '') "
    "AS bottleneck_restaurants, "
    "COALESCE(string_agg(CASE WHEN growth_opportunity THEN restaurant_name END, '|' ORDER BY restaurant_name), '') "
    "AS growth_opportunity_restaurants FROM card")
ORACLE["reconcile_metrics"] = _with(
    ",\n".join([FO, _keyed("restaurant_name"), _metrics("restaurant_name", False),
                "e AS (SELECT restaurant_name, COUNT(*) AS order_count, "
                "COALESCE(SUM(CASE WHEN isfinite(total) THEN total END), 0) AS total_revenue, "
                "AVG(CASE WHEN isfinite(kpt) THEN kpt END) AS avg_kpt, "
                "AVG(CASE WHEN isfinite(wait) THEN wait END) AS avg_rider_wait FROM k GROUP BY restaurant_name)",
                "j AS (SELECT COALESCE(m.restaurant_name, e.restaurant_name) AS restaurant_name, "
                "m.restaurant_name IS NOT NULL AND e.restaurant_name IS NOT NULL AS both_sides, "
                "m.restaurant_name IS NOT NULL AS in_a, "
                "m.order_count AS a_n, e.order_count AS e_n, m.total_revenue AS a_rev, e.total_revenue AS e_rev, "
                "m.avg_kpt AS a_kpt, e.avg_kpt AS e_kpt, m.avg_rider_wait AS a_wait, e.avg_rider_wait AS e_wait "
                "FROM m FULL OUTER JOIN e ON m.restaurant_name = e.restaurant_name)",
                "r AS (SELECT restaurant_name, "
                "CASE WHEN both_sides THEN 'both' WHEN in_a THEN 'only_actual' ELSE 'only_expected' END AS side, "
                "CASE WHEN both_sides THEN COALESCE(a_n = e_n, false) END AS count_match, "
                "CASE WHEN both_sides THEN ROUND(CASE WHEN e_rev > 0 THEN abs(a_rev - e_rev) / e_rev * 100 ELSE 0.0 END, 4) END "
                "AS revenue_diff_pct, "
                "CASE WHEN both_sides THEN ROUND(CASE WHEN e_kpt IS NULL THEN 0.0 ELSE abs(a_kpt - e_kpt) END, 4) END "
                "AS kpt_diff_minutes, "
                "CASE WHEN both_sides THEN ROUND(CASE WHEN e_wait IS NULL THEN 0.0 ELSE abs(a_wait - e_wait) END, 4) END "
                "AS wait_diff_minutes FROM j)"]),
    "SELECT *, COALESCE(count_match AND revenue_diff_pct <= 0.01 AND kpt_diff_minutes <= 0.01 "
    "AND wait_diff_minutes <= 0.01, false) AS within_tolerance FROM r")

_M_ID = ",\n".join([FO, _keyed("restaurant_id"), _metrics("restaurant_id")])
_M_NAME = ",\n".join([FO, _keyed("restaurant_name"), _metrics("restaurant_name")])
ORACLE["weighted_vs_unweighted_aov"] = _with(_M_ID, "SELECT ROUND(SUM(total_revenue) / SUM(order_count), 2) AS weighted_aov, "
                                             "ROUND(AVG(avg_order_value), 2) AS unweighted_aov FROM m")
ORACLE["kpt_rating_corr"] = _with(_M_ID, "SELECT ROUND(corr(avg_kpt, avg_rating), 4) AS kpt_rating_corr, "
                                  "COUNT(CASE WHEN avg_kpt IS NOT NULL AND avg_rating IS NOT NULL THEN 1 END) AS n_restaurants FROM m")
ORACLE["top3_ratings"] = _with(_M_ID, "SELECT restaurant_id, restaurant_name, avg_rating, order_count FROM m "
                               "WHERE avg_rating IS NOT NULL ORDER BY avg_rating DESC, restaurant_id, restaurant_name LIMIT 3")
ORACLE["volume_share"] = _with(_M_NAME, "SELECT restaurant_name, order_count, "
                               "ROUND(CAST(order_count AS DOUBLE) * 100 / tot, 2) AS volume_share_pct "
                               "FROM m CROSS JOIN (SELECT SUM(order_count) AS tot FROM m)")
ORACLE["slow_kitchens"] = _with(_M_ID, "SELECT restaurant_id, restaurant_name, avg_kpt, avg_rider_wait, order_count FROM m "
                                "WHERE avg_kpt > 19")
ORACLE["extremes"] = _with(_M_ID, " UNION ALL ".join(
    f"SELECT '{f}' AS finding, restaurant_id, restaurant_name, {c} AS value FROM m WHERE {c} = (SELECT {a}({c}) FROM m)"
    for f, c, a in [("highest_kpt", "avg_kpt", "MAX"), ("highest_aov", "avg_order_value", "MAX"),
                    ("lowest_rating", "avg_rating", "MIN")]))


# --- profiling and cleaning ----------------------------------------------------
from orderlens.schema import (  # noqa: E402
    CATEGORICAL, COLUMNS, FINANCIAL, MISSING_TOKENS, NUMERIC, RAW_COLUMNS, STATUS_DEPENDENT, TEXT,
)

_TOKENS = ", ".join("'" + t.replace("'", "''") + "'" for t in MISSING_TOKENS)
# DuckDB spellings of the timestamp layouts tried by ``to_ts`` (same order).
_TS_FORMATS = ("['%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M', '%Y-%m-%d', "
               "'%I:%M %p, %B %d %Y', '%d-%m-%Y %H:%M', '%m/%d/%Y %H:%M']")


def _miss(c: str) -> str:
    return f"({c} IS NULL OR {c} IN ({_TOKENS}))"


def _dbl(s: str) -> str:
    return f"CASE WHEN isfinite(TRY_CAST({s} AS DOUBLE)) THEN TRY_CAST({s} AS DOUBLE) END"


def _clean_text(c: str) -> str:
    return strip(f"CASE WHEN NOT {_miss(c)} THEN {c} END")


def _clean_value(c: str) -> str:
    s = _clean_text(c)
    if c in NUMERIC:
        return _dbl(s)
    if c == "order_placed_at":
        return f"try_strptime({s}, {_TS_FORMATS})"
    return s


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_CLEAN_SELECT = ", ".join(
    [f"{_clean_value(c)} AS {c}" for c in RAW_COLUMNS]
    + [f"{_clean_text('order_placed_at')} AS order_placed_at_raw",
       "(false OR " + " OR ".join(f"COALESCE({_clean_value(c)} < 0, false)" for c in FINANCIAL)
       + ") AS flag_negative_financial"])
CLEAN = f"clean AS (SELECT {_CLEAN_SELECT} FROM raw)"

ORACLE["shape"] = _with(RAW, f"SELECT COUNT(*) AS rows, {len(RAW_COLUMNS)} AS columns FROM raw")
ORACLE["missing_report"] = _with(RAW, _union([
    f"SELECT '{c}' AS \"column\", CAST(SUM(CASE WHEN {_miss(c)} THEN 1 ELSE 0 END) AS BIGINT) AS missing_count, "
    f"ROUND(CAST(SUM(CASE WHEN {_miss(c)} THEN 1 ELSE 0 END) AS DOUBLE) * 100 / COUNT(*), 2) AS missing_pct, "
    f"'string' AS dtype FROM raw" for c in RAW_COLUMNS]))
ORACLE["missing_rate_by_status"] = _with(RAW, _union([
    f"SELECT order_status, '{c}' AS \"column\", ROUND(AVG(CASE WHEN {_miss(c)} THEN 1.0E0 ELSE 0.0E0 END), 3) "
    f"AS missing_rate FROM raw WHERE NOT {_miss('order_status')} GROUP BY order_status" for c in STATUS_DEPENDENT]))


def _num_audit(c: str, col_alias: str = "non_numeric") -> str:
    p = f"TRY_CAST({strip(c)} AS DOUBLE)"
    v = _dbl(strip(c))
    return (f"SELECT '{c}' AS \"column\", CAST(COALESCE(SUM(CASE WHEN NOT {_miss(c)} AND {p} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) "
            f"AS {col_alias}, MIN({v}) AS min, MAX({v}) AS max, "
            f"CAST(COALESCE(SUM(CASE WHEN {v} < 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS negatives FROM raw")


ORACLE["numeric_audit"] = _with(RAW, _union([_num_audit(c) for c in NUMERIC]))
ORACLE["coercion_failures"] = _with(RAW, _union([
    f"SELECT '{c}' AS \"column\", CAST(COALESCE(SUM(CASE WHEN NOT {_miss(strip(c))} AND TRY_CAST({strip(c)} AS DOUBLE) IS NULL "
    f"THEN 1 ELSE 0 END), 0) AS BIGINT) AS failed FROM raw" for c in NUMERIC]))
ORACLE["rating_out_of_range"] = _with(
    RAW, f"SELECT CAST(SUM(CASE WHEN {_dbl(strip('rating'))} < 1 OR {_dbl(strip('rating'))} > 5 THEN 1 ELSE 0 END) AS BIGINT) "
         "AS out_of_range FROM raw")
_TS = f"try_strptime({strip('CAST(order_placed_at AS VARCHAR)')}, {_TS_FORMATS})"
ORACLE["timestamp_audit"] = _with(
    RAW, f"SELECT CAST(SUM(CASE WHEN NOT {_miss('order_placed_at')} THEN 1 ELSE 0 END) AS BIGINT) AS present, "
         f"COUNT({_TS}) AS parsed, "
         f"CAST(SUM(CASE WHEN NOT {_miss('order_placed_at')} AND {_TS} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unparseable, "
         f"MIN({_TS}) AS min_ts, MAX({_TS}) AS max_ts FROM raw")
_PAIRS = "pairs AS (" + _union([f"SELECT '{c}' AS \"column\", CASE WHEN NOT {_miss(c)} THEN {c} END AS value FROM raw"
                                for c in CATEGORICAL]) + ")"
ORACLE["categorical_top15"] = _with(
    RAW + ",\n" + _PAIRS + ',\ncounts AS (SELECT "column", value, COUNT(*) AS count FROM pairs GROUP BY "column", value)',
    'SELECT * FROM (SELECT "column", value, count, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, '
    "value ASC NULLS FIRST) AS rank FROM counts) WHERE rank <= 15")
_ALLPAIRS = "pairs AS (" + _union([f"SELECT '{c}' AS \"column\", CASE WHEN NOT {_miss(c)} THEN {c} END AS value FROM raw"
                                   for c in RAW_COLUMNS]) + ")"
ORACLE["distinct_counts"] = _with(RAW + ",\n" + _ALLPAIRS,
                                  'SELECT "column", COUNT(DISTINCT value) AS distinct_values FROM pairs GROUP BY "column"')
ORACLE["text_audit"] = _with(RAW, _union([
    f"SELECT '{c}' AS \"column\", CAST(SUM(CASE WHEN contains({c}, ',') THEN 1 ELSE 0 END) AS BIGINT) AS with_comma, "
    f"CAST(SUM(CASE WHEN contains({c}, '\"') THEN 1 ELSE 0 END) AS BIGINT) AS with_quote FROM raw" for c in TEXT]))
ORACLE["strip_strings"] = _with(RAW, "SELECT " + ", ".join(f"{strip(c)} AS {c}" for c in RAW_COLUMNS) + " FROM raw")
ORACLE["coerce_numeric"] = _with(RAW, "SELECT order_id, " + ", ".join(f"{_clean_value(c)} AS {c}" for c in NUMERIC)
                                 + " FROM raw")
ORACLE["parse_timestamp"] = _with(RAW, f"SELECT {_clean_text('order_id')} AS order_id, "
                                       f"{_clean_value('order_placed_at')} AS order_placed_at, "
                                       f"{_clean_text('order_placed_at')} AS order_placed_at_raw FROM raw")
ORACLE["negative_flag"] = _with(RAW + ",\n" + CLEAN, "SELECT flag_negative_financial, COUNT(*) AS rows FROM clean "
                                                     "GROUP BY flag_negative_financial")
ORACLE["clean_orders"] = _with(RAW + ",\n" + CLEAN, "SELECT * FROM clean")
ORACLE["missing_after_clean"] = _with(RAW + ",\n" + CLEAN, "SELECT * FROM (" + _union([
    f"SELECT '{c}' AS \"column\", CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_count, "
    f"ROUND(CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) * 100 / COUNT(*), 2) AS missing_pct, "
    f"'{'double' if c in NUMERIC else 'timestamp_ntz' if c == 'order_placed_at' else 'boolean' if c == 'flag_negative_financial' else 'string'}' "
    f"AS dtype FROM clean" for c in COLUMNS]) + ') ORDER BY missing_count DESC, \"column\" LIMIT 15')
ORACLE["before_after_diff"] = _with(RAW, _union([
    f"SELECT '{c}' AS \"column\", "
    f"CAST(SUM(CASE WHEN NOT {_miss(c)} AND {strip(c)} <> {c} THEN 1 ELSE 0 END) AS BIGINT) AS stripped_cells, "
    f"CAST(SUM(CASE WHEN {c} IS NOT NULL AND ({_clean_value(c)}) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulled_cells "
    f"FROM raw" for c in RAW_COLUMNS]))
ORACLE["preview_top_n"] = _with(RAW, "SELECT * FROM raw ORDER BY order_id LIMIT 5")
ORACLE["reject_empty_keys"] = _with(RAW + ",\n" + CLEAN, f"SELECT COUNT(*) AS rows FROM clean WHERE length({strip('restaurant_id')}) > 0")
ORACLE["csv_round_trip"] = ORACLE["clean_orders"]
ORACLE["csv_line_ends_round_trip"] = _with(
    RAW + ",\n" + CLEAN, "SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN coalesce(instructions, '') || chr(10) "
    "|| 'ring \"twice\",' || chr(13) || chr(10) || chr(10) || 'then wait' ELSE instructions END AS instructions) FROM clean")
ORACLE["typed_orders_orc"] = ORACLE["clean_orders"]
ORACLE["kv_tsv_source"] = _with(",\n".join([FO, _keyed("restaurant_id"), _metrics("restaurant_id", False)]),
                                "SELECT restaurant_id, restaurant_name, CAST(order_count AS DOUBLE) AS order_count, "
                                "total_revenue, avg_order_value, avg_kpt, avg_rider_wait FROM m")
ORACLE["plain_tsv_source"] = ORACLE["perf_by_restaurant_id"]
ORACLE["reject_short_rows"] = _with(RAW, "SELECT restaurant_id AS first_field, CAST(20 AS INTEGER) AS fields "
                                         "FROM raw WHERE CAST(order_id AS BIGINT) % 37 = 0")
ORACLE["scorecard_from_files"] = ORACLE["scorecard_by_name"]
ORACLE["validation_report"] = ORACLE["reconcile_metrics"].replace(
    "SELECT *, COALESCE(count_match AND", "SELECT CASE WHEN COUNT(*) FILTER (WHERE side <> 'both' OR NOT ok) OVER () > 0 "
    "THEN 'MISMATCH' ELSE 'SUCCESS' END AS status, * EXCLUDE (ok) FROM (SELECT *, COALESCE(count_match AND").replace(
    "AS within_tolerance FROM r", "AS ok FROM r)")

_MEASURES = {
    "order_count": "BIGINT", "total_revenue": "DOUBLE", "avg_order_value": "DOUBLE", "avg_kpt": "DOUBLE", "max_kpt": "DOUBLE",
    "min_kpt": "DOUBLE", "avg_rider_wait": "DOUBLE", "avg_rating": "DOUBLE", "num_ratings": "BIGINT",
    "restaurant_name": "VARCHAR", "total": "DOUBLE",
}


def _result(title: str, query: str, key: str, **measures: str) -> str:
    """One result as a row of the common shape: the title, the key as text, its measures, NULL for the others."""
    cols = ", ".join(f"CAST({measures.get(m, 'NULL')} AS {t}) AS {m}" for m, t in _MEASURES.items())
    number = title.split(":")[0].removeprefix("--- Q").zfill(2)
    body = ORACLE[query].removeprefix(f"WITH {FO}\n")
    return f"SELECT 'q{number}' AS query, '{title}' AS query_title, CAST({key} AS VARCHAR) AS group_key, {cols} FROM ({body}) AS r{number}"


ORACLE["all_results"] = _with(FO, _union([
    _result("--- Q1: Total Orders ---", "q01_total_orders", "NULL", order_count="total_orders"),
    _result("--- Q2: Orders by Restaurant ---", "q02_orders_by_restaurant", "restaurant_name", order_count="order_count"),
    _result("--- Q3: Orders by Status ---", "q03_orders_by_status", "order_status", order_count="cnt"),
    _result("--- Q4: Revenue by Restaurant ---", "q04_revenue_by_restaurant", "restaurant_name", total_revenue="total_revenue"),
    _result("--- Q5: Average Order Value by Restaurant ---", "q05_avg_order_value", "restaurant_name",
            avg_order_value="avg_order_value"),
    _result("--- Q6: Top 10 Highest-Value Orders ---", "q06_top_orders", "order_id", restaurant_name="restaurant_name", total="total"),
    _result("--- Q7: Kitchen Prep Time (KPT) by Restaurant ---", "q07_kpt_by_restaurant", "restaurant_name", avg_kpt="avg_kpt",
            max_kpt="max_kpt", min_kpt="min_kpt"),
    _result("--- Q8: Rider Wait Time by Restaurant ---", "q08_rider_wait_by_restaurant", "restaurant_name",
            avg_rider_wait="avg_rider_wait"),
    _result("--- Q9: Distance-based Order Behaviour ---", "q09_distance_behaviour", "distance", order_count="order_count",
            avg_order_value="avg_order_value"),
    _result("--- Q10: Customer Rating and Review Count by Restaurant ---", "q10_rating_by_restaurant", "restaurant_name",
            avg_rating="avg_rating", num_ratings="num_ratings"),
    _result("--- Q11: Most Frequent Customer Complaints ---", "q11_complaint_types", "customer_complaint_tag",
            order_count="complaint_count"),
    _result("--- Q12: High-Performing Restaurants (Volume > 500 & Rating >= 4.0) ---", "q12_high_performing", "restaurant_name",
            order_count="order_count", avg_rating="avg_rating", avg_kpt="avg_kpt"),
]))

ORACLE["perf_from_buckets"] = ORACLE["perf_by_restaurant_id"]
ORACLE["orders_by_month"] = _with(FO, "SELECT CAST(date_trunc('month', order_placed_at) AS DATE) AS order_day, COUNT(*) AS order_count, "
                                      "ROUND(SUM(total), 2) AS total_revenue FROM fo GROUP BY 1")
ORACLE["profile_merged"] = _with(RAW, f"""SELECT m."column", (SELECT COUNT(*) FROM raw) AS rows, m.missing_count AS missing,
  n.non_numeric, n.negatives, t.with_comma, t.with_quote, n.min, n.max, m.missing_pct, TRUE AS distinct_within
FROM ({ORACLE["missing_report"]}) m LEFT JOIN ({ORACLE["numeric_audit"]}) n ON m."column" = n."column"
LEFT JOIN ({ORACLE["text_audit"]}) t ON m."column" = t."column" """)
ORACLE["categorical_top_merged"] = ORACLE["categorical_top15"]
ORACLE["reconcile_rows"] = _with(FO + """, n AS (SELECT order_id, CAST(order_id AS BIGINT) AS number FROM fo)""", """SELECT order_id, CASE WHEN number % 97 = 0 THEN 'only_left' WHEN number % 101 = 0 THEN 'copies' ELSE 'changed' END AS difference,
  CAST(1 AS BIGINT) AS left_rows, CAST(CASE WHEN number % 97 = 0 THEN 0 WHEN number % 101 = 0 THEN 2 ELSE 1 END AS BIGINT) AS right_rows,
  CASE WHEN number % 97 <> 0 AND number % 101 <> 0 THEN 'total' END AS changed_columns
FROM n WHERE number % 97 = 0 OR number % 101 = 0 OR number % 89 = 0""")
ORACLE["schema_check"] = _with(FO, "SELECT * FROM (VALUES ('bad', 'Gold discount', 'missing'), ('bad', 'Gold rebate', 'unexpected'), "
                                   "('bad', 'Extra', 'unexpected')) AS found(folder, \"column\", status) WHERE EXISTS (SELECT 1 FROM fo)")

ORACLE["summary_names"] = _with(_card_ctes("restaurant_name"), _union([
    f"SELECT '{flag}' AS section, restaurant_name FROM card WHERE {flag}" for flag in ("bottleneck", "growth_opportunity")]))
ORACLE["validation_status"] = ("SELECT CASE WHEN COUNT(*) FILTER (WHERE bad) > 0 THEN 'MISMATCH' ELSE 'SUCCESS' END AS status, "
                               "COUNT(*) AS compared, COUNT(*) FILTER (WHERE bad) AS failed FROM "
                               f"(SELECT side <> 'both' OR NOT within_tolerance AS bad FROM ({ORACLE['reconcile_metrics']}) AS r) AS b")
ORACLE["end_to_end_scorecard"] = ORACLE["scorecard_by_name"].replace(FO, RAW + ",\n" + CLEAN).replace("FROM fo", "FROM clean")

# --- remaining report shapes ----------------------------------------------------
ORACLE["q01_with_title"] = _with(FO, "SELECT '--- Q1: Total Orders ---' AS query_title, COUNT(*) AS total_orders FROM fo")
ORACLE["timestamp_samples"] = _with(RAW, f"SELECT order_id, order_placed_at FROM raw WHERE NOT {_miss('order_placed_at')} "
                                         "ORDER BY order_id LIMIT 10")
ORACLE["top3_volume_share"] = _with(
    _M_ID + ",\ntop AS (SELECT restaurant_id FROM m WHERE avg_rating IS NOT NULL "
            "ORDER BY avg_rating DESC, restaurant_id, restaurant_name LIMIT 3)",
    "SELECT COUNT(*) AS restaurants, CAST(SUM(order_count) AS BIGINT) AS orders, "
    "ROUND(CAST(SUM(order_count) AS DOUBLE) * 100 / (SELECT SUM(order_count) FROM m), 3) AS volume_share_pct "
    "FROM m WHERE restaurant_id IN (SELECT restaurant_id FROM top)")
