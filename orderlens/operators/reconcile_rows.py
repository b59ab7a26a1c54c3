"""Two copies of the order table compared down to the rows.

Both sides are first summed up in order-free checksums: for each restaurant and
bucket of order ids the number of rows and two sums over row hashes.  A row that
is missing, added, repeated or changed in any column changes the checksum of its
bucket; equal buckets are done, whatever the order or the files of their rows.
Only rows of differing buckets are then shuffled, by order id, and compared
column by column.  So copies that agree cost two scans and a join of checksums,
and the second step grows with the differences.

The checksum step is partially aggregated, and a restaurant that holds a third of
all orders is compared in as many buckets as any other; its rows are spread by order id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.plans.materialize import materialize

BUCKETS = 256
SUMS = ("_rows", "_high", "_low")


def _row_hash(columns: Sequence[str]) -> Column:
    # NULL cells do not change a hash: which cells are NULL is hashed along
    return F.xxhash64(*columns, F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns]))


def _keyed(df: DataFrame, key: str, id_col: str, columns: Sequence[str], buckets: int) -> DataFrame:
    return df.select(F.col(key).alias("_key"), F.pmod(F.xxhash64(id_col), F.lit(buckets)).alias("_bucket"), F.col(id_col).alias("_id"),
                     _row_hash(columns).alias("_hash"), F.struct(*columns).alias("_row"))


def _sums() -> list[Column]:
    """Rows, and sums of both halves of the hashes: repeated rows do not cancel out, and no sum can overflow a decimal."""
    high, low = F.shiftright("_hash", 32), F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))
    return [F.count(F.lit(1)).alias("_rows"), F.sum(high.cast("decimal(20,0)")).alias("_high"),
            F.sum(low.cast("decimal(20,0)")).alias("_low")]


def checksums(df: DataFrame, key: str = "restaurant_id", id_col: str = "order_id", columns: Sequence[str] | None = None,
              buckets: int = BUCKETS) -> DataFrame:
    """(key, bucket, rows, two sums): equal for equal bags of rows."""
    return _keyed(df, key, id_col, columns or df.columns, buckets).groupBy("_key", "_bucket").agg(*_sums())


def differing_buckets(left: DataFrame, right: DataFrame, key: str = "restaurant_id", id_col: str = "order_id",
                      columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(_key, _bucket) whose rows are not the same on both sides."""
    a, b = (checksums(s, key, id_col, columns or left.columns, buckets).alias(n) for s, n in ((left, "a"), (right, "b")))
    same_place = F.col("a._key").eqNullSafe(F.col("b._key")) & (F.col("a._bucket") == F.col("b._bucket"))
    differ = ~F.struct(*[f"a.{c}" for c in SUMS]).eqNullSafe(F.struct(*[f"b.{c}" for c in SUMS]))
    return a.join(b, same_place, "full").where(differ).select(
        F.when(F.col("a._rows").isNotNull(), F.col("a._key")).otherwise(F.col("b._key")).alias("_key"),
        F.coalesce("a._bucket", "b._bucket").alias("_bucket"))


def reconcile_rows(left: DataFrame, right: DataFrame, key: str = "restaurant_id", id_col: str = "order_id",
                   columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """One row for each order that is not the same on both sides.

    id, ``difference`` (only_left, only_right, changed, copies), rows on either side, and the names of the changed columns
    joined by ``|``.  ``copies``: an id with several rows on a side, not the same bag of rows on both."""
    columns = list(columns or left.columns)
    places = materialize(differing_buckets(left, right, key, id_col, columns, buckets), "differing_buckets").alias("p")
    sides = []
    for name, df in (("left", left), ("right", right)):
        rows = _keyed(df, key, id_col, columns, buckets).alias("r")
        here = F.col("r._key").eqNullSafe(F.col("p._key")) & (F.col("r._bucket") == F.col("p._bucket"))
        sides.append(rows.join(places, here, "left_semi").select("_id", "_hash", "_row", F.lit(name == "left").alias("_is_left")))
    aggs = []
    for name, mine in (("l", F.col("_is_left")), ("r", ~F.col("_is_left"))):
        own = lambda c, mine=mine: F.when(mine, c)
        aggs += [F.count_if(mine).alias(f"_{name}"), F.max(own(F.col("_row"))).alias(f"_{name}_row"),
                 F.sum(own(F.shiftright("_hash", 32).cast("decimal(20,0)"))).alias(f"_{name}_high"),
                 F.sum(own(F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF)).cast("decimal(20,0)"))).alias(f"_{name}_low")]
    by_id = sides[0].unionByName(sides[1]).groupBy("_id").agg(*aggs)
    single = (F.col("_l") == 1) & (F.col("_r") == 1)
    equal = F.struct("_l", "_l_high", "_l_low").eqNullSafe(F.struct(F.col("_r").alias("_l"), F.col("_r_high"), F.col("_r_low")))
    difference = (F.when(F.col("_r") == 0, "only_left").when(F.col("_l") == 0, "only_right")
                  .when(single, "changed").otherwise("copies"))
    changed = F.array_compact(F.array(*[F.when(~F.col(f"_l_row.{c}").eqNullSafe(F.col(f"_r_row.{c}")), F.lit(c)) for c in columns]))
    return by_id.where(~equal).select(
        F.col("_id").alias(id_col), difference.alias("difference"), F.col("_l").alias("left_rows"), F.col("_r").alias("right_rows"),
        F.when(single, F.array_join(changed, "|")).alias("changed_columns"))
