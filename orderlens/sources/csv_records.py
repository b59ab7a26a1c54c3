r"""Records of CSV files whose quoted cells hold line ends, put together without giving up splits.

Spark reads a CSV file either in splits, where a line is a record, or, with
``multiLine``, as a whole in one task.  Here both kinds of file are split.  What
a line does to the reader's state (outside or inside a quoted cell at its end,
given where it began) is a function of two values, found by one regular
expression for each; functions compose, so

1. ``files_with_line_ends`` names the files in which a line that begins outside
   ends inside: one scan of the text, one row a file.  Other files go to the
   split reader as they are;
2. ``records`` composes the functions of a file's lines: those of ``CHUNK`` lines
   at a time, gathered as the bits of two numbers, for both possible beginnings,
   then over the chunks of a split and over the splits of a file, and joins the
   states each chunk's lines begin in back to them.  Windows and aggregates hold
   a row a chunk, never text, and the text is not sorted: the join builds its
   hash table from the chunks.

Lines that are whole records pass as they are; only the lines of a record that
has line ends are grouped.  A quote that is never closed makes no record of the
rest of the file: its lines stay lines.  Blank lines between records are
dropped, as the split reader does; ``\n`` and ``\r\n`` end a record, and inside
a cell both stay as they were written.  Quotes open a cell at its start only.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.plans.materialize import materialize

# possessive throughout: matching never recurses, so cells may have any length
_REST = r'[^"]*+(?:""[^"]*+)*+'  # of a quoted cell, up to its closing quote
_CELLS = rf'(?:(?:[^",][^,]*+)?+,|"{_REST}"[^,]*+,)*+'  # whole cells, each with its comma
_OPEN = rf'"{_REST}\z'
OPENS = rf"\A{_CELLS}{_OPEN}"
STAYS_INSIDE = rf'\A{_REST}(?:\z|"[^,]*+,{_CELLS}{_OPEN})'

CHUNK = 64  # lines whose states are the bits of one bigint


def _matches(line: Column, pattern: str) -> Column:
    return F.coalesce(line.rlike(pattern), F.lit(False))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, file, block (where the split begins), id (in line order within a split)."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("id"))


def files_with_line_ends(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[str]]:
    """(files with a line end inside quotes, all others)."""
    opens = F.col("value").contains('"') & _matches(F.col("value"), OPENS)
    found = _lines(spark, path).groupBy("file").agg(F.max(opens).alias("opens")).collect()
    names = {r["file"]: r["opens"] for r in found}
    # the metadata column has the file's URI, a reader takes a path
    return (sorted(unquote(f) for f, opens in names.items() if opens),
            sorted(unquote(f) for f, opens in names.items() if not opens))


def _state_after(outside: Column, inside: Column, window) -> tuple[Column, Column, Column]:
    """Columns to add in turn for the running composition of (outside, inside) -> state, both booleans "is inside".

    swaps: how often the state has been turned over; fixed: the last line that decides the state alone, with the swaps
    then; the state after a line that began (the window) inside or outside follows from these."""
    swaps = F.sum((outside & ~inside).cast("long")).over(window)
    fixed = F.last(F.when(outside == inside, F.struct(outside.alias("inside"), F.col("swaps"))), ignorenulls=True).over(window)

    turned = lambda state, times: state != (F.pmod(times, F.lit(2)) == 1)
    after = F.when(F.col("fixed").isNotNull(), turned(F.col("fixed.inside"), F.col("swaps") - F.col("fixed.swaps")))
    return swaps, fixed, F.array(*(F.coalesce(after, turned(F.lit(begun), F.col("swaps"))) for begun in (False, True)))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _through(begun: bool) -> Column:
    """Through a chunk that begins inside or outside: inside (its end is), before (bits of the lines that begin inside)."""
    def line(s: Column, k: Column) -> Column:
        return F.struct(F.when(s["inside"], F.getbit("closes", k) == 0).otherwise(F.getbit("opens", k) == 1).alias("inside"),
                        s["before"].bitwiseOR(F.when(s["inside"], _bit(k)).otherwise(F.lit(0).cast("bigint"))).alias("before"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(CHUNK - 1)),
                       F.struct(F.lit(begun).alias("inside"), F.lit(0).cast("bigint").alias("before")), line)


def _starts(before: Column, among: Column | None = None) -> Column:
    """How many lines of a chunk, or among some bits of it, begin a record."""
    begins = F.col("lines").bitwiseAND(F.bitwise_not(before))
    return F.bit_count(begins if among is None else begins.bitwiseAND(among)).cast("bigint")


def _chunk_states(lines: DataFrame) -> DataFrame:
    """A row a chunk of lines: file, block, chunk, lines and before (bits), number (of the records of the file that begin
    above the chunk), and of the file: unclosed (number of the record never closed), top, top_number (its first line)."""
    gather = lambda flag: F.bit_or(F.when(flag, _bit(F.col("place"))).otherwise(F.lit(0).cast("bigint")))
    blank = F.length(F.trim("value")) == 0
    chunks = lines.groupBy("file", "block", "chunk").agg(
        gather(F.lit(True)).alias("lines"), gather(F.col("opens")).alias("opens"), gather(F.col("closes")).alias("closes"),
        F.min("id").alias("first"), F.min(F.when(~blank & (F.col("block") == 0), F.col("id"))).alias("top"))
    split = Window.partitionBy("file", "block").orderBy("chunk")
    chunks = chunks.withColumn("outside", _through(False)).withColumn("inside", _through(True))
    swaps, fixed, after = _state_after(F.col("outside.inside"), F.col("inside.inside"), split)
    chunks = chunks.withColumn("swaps", swaps).withColumn("fixed", fixed).withColumn("after", after)
    # two values everywhere: for a split that begins outside and one that begins inside a quoted cell
    begun = [F.coalesce(F.lag("after").over(split)[k], F.lit(bool(k))) for k in (0, 1)]
    states = F.array(*(F.when(b, F.col("inside.before")).otherwise(F.col("outside.before")) for b in begun))
    chunks = materialize(chunks.select("file", "block", "chunk", "lines", "first", "top", "after", states.alias("states")), "csv_chunks")

    blocks = chunks.groupBy("file", "block").agg(
        F.max_by(F.col("after")[0], "chunk").alias("outside"), F.max_by(F.col("after")[1], "chunk").alias("inside"),
        F.sum(_starts(F.col("states")[0])).alias("started_outside"), F.sum(_starts(F.col("states")[1])).alias("started_inside"),
        F.min("first").alias("first"), F.min("top").alias("top"))
    in_file = Window.partitionBy("file").orderBy("block")
    whole = in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = in_file.rowsBetween(Window.unboundedPreceding, -1)
    swaps, fixed, after = _state_after(F.col("outside"), F.col("inside"), in_file)
    blocks = (blocks.withColumn("swaps", swaps).withColumn("fixed", fixed).withColumn("after", after[0])
              .withColumn("begun", F.coalesce(F.lag("after").over(in_file), F.lit(False)))
              .withColumn("started", F.when(F.col("begun"), F.col("started_inside")).otherwise(F.col("started_outside"))))
    blocks = blocks.select(
        "file", "block", "begun", F.coalesce(F.sum("started").over(above), F.lit(0)).alias("above"),
        F.when(F.last("after").over(whole), F.sum("started").over(whole)).alias("unclosed"),
        F.first("top", ignorenulls=True).over(whole).alias("top"),
        # the lines above it are blank, so each is a record of its own
        F.first(F.col("top") - F.col("first") + 1, ignorenulls=True).over(whole).alias("top_number"))

    chunks = chunks.drop("top").join(blocks, ["file", "block"]).withColumn("before", F.col("states")[F.col("begun").cast("int")])
    return chunks.select("file", "block", "chunk", "lines", "before", "unclosed", "top", "top_number", (F.col("above") + F.coalesce(
        F.sum(_starts(F.col("before"))).over(split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("number"))


def records(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """The records of CSV files as text: file, record; without each file's first one if that is a header."""
    quote = F.col("value").contains('"')
    lines = _lines(spark, path).withColumns({"opens": quote & _matches(F.col("value"), OPENS),
                                             "closes": quote & ~_matches(F.col("value"), STAYS_INSIDE)})
    lines = materialize(lines, "csv_lines").withColumns({"chunk": F.shiftright("id", CHUNK.bit_length() - 1),
                                                         "place": F.pmod("id", F.lit(CHUNK)).cast("int")})
    chunks = materialize(_chunk_states(lines), "csv_states")
    joined = lines.join(chunks.hint("shuffle_hash"), ["file", "block", "chunk"])
    upto = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), CHUNK - 1 - F.col("place"))
    joined = joined.select(
        "file", "block", "id", "value", "top", "top_number", "unclosed", "opens",
        (F.getbit("before", "place") == 1).alias("before"), (F.col("number") + _starts(F.col("before"), upto)).alias("key"))
    loose = F.col("key").eqNullSafe(F.col("unclosed"))
    if header:
        joined = joined.where(~F.when(loose, F.col("id").eqNullSafe(F.col("top"))).otherwise(
            F.col("key").eqNullSafe(F.col("top_number"))))
    single = loose | ~F.when(F.col("before"), F.lit(True)).otherwise(F.col("opens"))
    alone = joined.where(single & (F.length(F.trim("value")) > 0)).select("file", F.col("value").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("block", "id", "value")))
    several = joined.where(~single).groupBy("file", "key").agg(parts.alias("parts"))
    several = several.select("file", F.array_join(F.col("parts.value"), "\n").alias("record"))
    return alone.unionByName(several).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
