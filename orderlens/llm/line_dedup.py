r"""Line deduplication by content-defined line chunks (DataFrame operations only).

A text is cut at ``\n``.  Every line has a 28-bit hash; a rolling polynomial
hash runs over ``WINDOW`` adjacent line hashes, and its remainder by ``CLASSES``
is the window's class.  A chunk is a longest run of neighbouring windows of one
class, so it begins and ends where the class changes; equal neighbouring windows
(one line over and over) are chunks of their own.  Where a chunk is cut
depends on its own lines and on the one window on either side, so lines
inserted elsewhere shift no boundary.  Neighbouring chunks share ``WINDOW - 1``
lines: every window of adjacent lines lies in exactly one chunk, so a repeated
passage is found from its first line to its last, whatever stands around it,
unless a window that crosses the passage's edge has by chance the class of the
window inside (one in ``CLASSES`` an edge; a two-line passage has two edges).
Of a line that repeats over and over, the first two stay.

Every chunk has at least ``WINDOW`` lines.  Of the chunks that occur more than once in the
whole corpus, all but the occurrence with the smallest (id, text hash, position) are
removed.  A removed line always stands in an earlier occurrence of its chunk, or in
an earlier one still if that was removed with another chunk: no line is lost from the corpus.

Steps: chunk digests without text are written once (one small row a chunk) and
counted with partial aggregation; the chunks of repeated digests are fetched
and compared byte by byte (smallest against largest text under each digest);
confirmed occurrences are grouped per document and their lines dropped in one
pass over the positions.  No step carries a text's lines along with each of its chunks.  A hot chunk costs one partial row per task when counted, and
its occurrences are split by AQE's skew join when the first occurrence is joined to them.

Defined cases: a null text stays null and has no chunks; a text of fewer lines than
``WINDOW``, the empty text among them, has no chunks; chunks without a non-blank
character are never removed; digests
shared by different bytes are not removed; repeated rows with one id and one
text are one document, all of them changed alike; a null id sorts first; very
long texts are cut as a whole, at a cost linear in their lines; an
empty table gives no rows; further columns pass through, whatever their names, but for
those called as the added ones (``ADDED``), which win.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import table
from orderlens.plans.materialize import materialize

WINDOW = 2
BASE = 1_000_003
MODULUS = 2_147_483_647
CLASSES = 64
ADDED = ("n_lines", "n_chunks", "removed_chunks", "removed_lines")


def _shifted(array, by: int):
    return F.slice(array, F.lit(by + 1), F.size(array))


def _with_chunks(rows: DataFrame, text: str, p: str, window: int, classes: int) -> DataFrame:
    """Adds, under names that begin with ``p``: lines, their md5 (d), and by window whether a chunk
    begins (begins) or ends (last) with it."""
    # arrays are combined by position with shifted copies of themselves: a lambda
    # that refers to a whole array would have it evaluated anew for every element
    lines, d, h, rolled, begins = (p + name for name in ("lines", "d", "h", "rolled", "begins"))
    rows = rows.withColumn(lines, F.split(text, "\n", -1))
    rows = rows.withColumn(d, F.transform(lines, lambda line: F.md5(line.cast("binary"))))
    rows = rows.withColumn(h, F.transform(d, lambda x: F.conv(F.substring(x, 1, 7), 16, 10).cast("bigint")))
    roll = F.col(h)
    for ahead in range(1, window):
        # every factor is below 2**31, so products stay within 63 bits
        power = pow(BASE, ahead, MODULUS)
        roll = F.zip_with(roll, _shifted(F.col(h), ahead), lambda x, y: (x + y * F.lit(power)) % F.lit(MODULUS))
    rows = rows.withColumn(rolled, F.slice(roll, F.lit(1), F.greatest(F.size(h) - (window - 1), F.lit(0))))
    before = F.slice(F.concat(F.array(F.lit(-1).cast("bigint")), F.col(rolled)), F.lit(1), F.size(rolled))
    rows = rows.withColumn(begins, F.zip_with(rolled, before, lambda r, b: (r % classes != b % classes) | (r == b)))
    return rows.withColumn(p + "last", F.when(F.size(begins) > 0, F.concat(
        _shifted(F.col(begins), 1), F.array(F.lit(True)))).otherwise(F.array().cast("array<boolean>")))


def _positions(flags, shift: int = 0):
    return F.filter(F.transform(flags, lambda flag, i: F.when(flag, i + shift).otherwise(F.lit(-1))), lambda i: i >= 0)


def _images(units, last, window: int, joint: str, stop: str):
    """One string a chunk: its lines' ``units`` with ``joint`` between. All are written into one string with
    ``stop`` (which no unit or joint may form) behind each and split there, so the cost is linear in the lines."""
    whole = units
    for ahead in range(1, window):
        whole = F.zip_with(whole, _shifted(units, ahead), lambda x, y: F.concat(x, F.lit(joint), y))
    windows = F.zip_with(F.slice(units, F.lit(1), F.size(last)), F.slice(whole, F.lit(1), F.size(last)),
                         lambda unit, all_: F.struct(unit.alias("unit"), all_.alias("whole")))
    body = F.zip_with(windows, last, lambda w, ends: F.when(ends, F.concat(w["whole"], F.lit(stop)))
                      .otherwise(F.concat(w["unit"], F.lit(joint))))
    parts = F.split(F.array_join(body, ""), stop.replace("|", r"\|"), -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def _after(sorted_parts, field: str):
    """The ``field`` of the element before each, -1 for the first."""
    return F.slice(F.concat(F.array(F.lit(-1)), F.transform(sorted_parts, lambda c: c[field])),
                   F.lit(1), F.size(sorted_parts))


def _dropped_runs(cut):
    """For each removed chunk (sorted by position), the lines kept since the one before
    it and its own lines that the one before it has not dropped already."""
    return F.zip_with(cut, _after(cut, "end"), lambda c, b: F.struct(
        F.greatest(c["start"] - b - 1, F.lit(0)).alias("keep"),
        (c["end"] - F.greatest(c["start"] - 1, b)).alias("drop")))


def drop_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         window: int = WINDOW, classes: int = CLASSES) -> DataFrame:
    """``docs`` with repeated chunks of ``window`` and more lines removed from the text, and the
    counts in ``ADDED``."""
    key = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.col("_text").isNotNull())
    key = key.withColumn("_key", F.xxhash64("_text"))
    # a chunk's digest is that of its lines' digests; n marks a line with a non-blank character
    units = F.zip_with("_d", "_lines", lambda d, line: F.concat(
        F.when(line.rlike(r"\S"), F.lit("n")).otherwise(F.lit("_")), d))
    chunks = (_with_chunks(key, "_text", "_", window, classes).withColumn("_units", units)
              .select("_id", "_key", F.posexplode(F.arrays_zip(
                  _positions("_begins").alias("start"), _positions("_last", window - 1).alias("end"),
                  _images(F.col("_units"), F.col("_last"), window, "", "|").alias("units"))).alias("k", "c"))
              .where(F.col("c.units").contains("n"))
              .select("_id", "_key", "k", F.col("c.start").alias("start"), F.col("c.end").alias("end"),
                      F.unhex(F.md5(F.col("c.units").cast("binary"))).alias("digest")))
    chunks = materialize(chunks, "line_chunks")
    place = F.struct("_id", "_key", "k")
    # one document repeated under one id counts once: its rows are alike in every column here
    # (written first: an aggregate's output could not be re-dealt, and the join with a hot digest is split by AQE)
    repeated = materialize(chunks.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                           .where(~F.col("first").eqNullSafe(F.col("last"))).select("digest", "first"), "line_firsts")
    found = materialize(chunks.join(repeated, "digest")
                        .select("_id", "_key", "digest", "k", "start", "end",
                                place.eqNullSafe(F.col("first")).alias("stays")), "line_repeats")
    wanted = found.groupBy("_id", "_key").agg(F.sort_array(F.collect_set(F.struct("k", "digest"))).alias("_parts"))
    wanted = wanted.withColumnsRenamed({"_id": "_fid", "_key": "_fkey"})
    fetched = key.join(wanted.hint("merge"), F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_key") == F.col("_fkey")))
    fetched = _with_chunks(fetched.select("_text", "_parts"), "_text", "_", window, classes)
    # every line begins with =, so the stop between two chunks cannot stand anywhere else
    fetched = fetched.withColumn("_units", F.transform("_lines", lambda line: F.concat(F.lit("="), line)))
    aligned = F.flatten(F.zip_with("_parts", _after(F.col("_parts"), "k"), lambda c, b: F.concat(
        F.array_repeat(F.lit(None).cast("binary"), c["k"] - b - 1), F.array(c["digest"]))))
    fetched = (fetched.select(F.explode(F.filter(F.zip_with(
        aligned, _images(F.col("_units"), F.col("_last"), window, "\n", "\n#\n"),
        lambda digest, chunk: F.struct(digest.alias("digest"), chunk.alias("chunk"))),
        lambda c: c["digest"].isNotNull())).alias("c")).select("c.digest", "c.chunk"))
    alike = materialize(fetched.groupBy("digest").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"))
                        .where("a = b").select("digest"), "line_alike")
    rest = [c for c in docs.columns if c.lower() not in ADDED]
    p = "_"  # a prefix that no column of the caller's begins with
    while any(c.lower().startswith(p) for c in rest):
        p += "_"
    cut, runs, kept, lines = p + "cut", p + "runs", p + "kept", p + "lines"
    # written, so that the rows of one (id, text) may be split by AQE where they are joined to it
    cuts = materialize(found.where(~F.col("stays")).join(alike, "digest")
                       .groupBy("_id", "_key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("cut"))
                       .select(F.col("_id").alias(p + "cid"), F.col("_key").alias(p + "ckey"), F.col("cut").alias(cut)),
                       "line_cuts")
    whole = docs.select(*rest).withColumn(p + "key", F.xxhash64(text_col))
    whole = whole.join(cuts.hint("merge"),
                       F.col(id_col).eqNullSafe(F.col(p + "cid")) & (F.col(p + "key") == F.col(p + "ckey")), "left")
    out = _with_chunks(whole, text_col, p, window, classes).withColumn(runs, _dropped_runs(F.col(cut)))
    flags = F.flatten(F.transform(runs, lambda r: F.concat(
        F.array_repeat(F.lit(False), r["keep"]), F.array_repeat(F.lit(True), r["drop"]))))
    # beyond the last removed chunk the flags are null; array_join leaves the nulled lines out
    out = out.withColumn(kept, F.zip_with(lines, flags, lambda line, gone: F.when(~F.coalesce(gone, F.lit(False)), line)))
    none = F.lit(0).cast("bigint")
    return out.withColumns({
        text_col: F.when(F.col(cut).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")),
        "n_lines": F.coalesce(F.array_size(lines), F.lit(0)).cast("long"),
        "n_chunks": F.coalesce(F.array_size(F.filter(p + "begins", lambda begins: begins)), F.lit(0)).cast("long"),
        "removed_chunks": F.coalesce(F.array_size(cut), F.lit(0)).cast("long"),
        "removed_lines": F.coalesce(F.aggregate(runs, none, lambda a, r: a + r["drop"].cast("bigint")), none),
    }).select(*rest, *ADDED)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_chunks(docs)


SQL = f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM lines),
paired AS (
  SELECT *, lead(h) OVER (PARTITION BY doc_id ORDER BY i) AS h2, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS line2
  FROM hashed),
windows AS (SELECT *, (h + h2 * {pow(BASE, 1, MODULUS)}) % {MODULUS} AS r FROM paired WHERE h2 IS NOT NULL),
before AS (SELECT *, coalesce(lag(r) OVER (PARTITION BY doc_id ORDER BY i), -1) AS b FROM windows),
changes AS (SELECT *, r % {CLASSES} <> b % {CLASSES} OR r = b AS begins FROM before),
numbered AS (
  SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k
  FROM changes),
chunks AS (
  SELECT doc_id, k, min(i) AS s, max(i) + 1 AS e,
         string_agg(line, chr(10) ORDER BY i) || chr(10) || arg_max(line2, i) AS chunk
  FROM numbered GROUP BY doc_id, k),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, s) AS occurrence
  FROM chunks WHERE regexp_matches(chunk, '[^\\t\\n\\x0B\\f\\r ]')),
gone AS (SELECT doc_id, s, e FROM ranked WHERE occurrence > 1),
gone_lines AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM gone),
rebuilt AS (
  SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text,
         count(*) AS n_lines, count(g.i) AS removed_lines
  FROM lines l LEFT JOIN gone_lines g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id),
cut AS (SELECT doc_id, count(*) AS n_chunks FROM chunks GROUP BY doc_id),
dropped AS (SELECT doc_id, count(*) AS removed_chunks FROM gone GROUP BY doc_id)
SELECT d.doc_id, r.text, coalesce(r.n_lines, 0) AS n_lines, coalesce(c.n_chunks, 0) AS n_chunks,
       coalesce(g.removed_chunks, 0) AS removed_chunks, coalesce(r.removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN rebuilt r ON d.doc_id = r.doc_id LEFT JOIN cut c ON d.doc_id = c.doc_id
LEFT JOIN dropped g ON d.doc_id = g.doc_id
"""
