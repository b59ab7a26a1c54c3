"""CSV sources and sinks in one RFC-4180 dialect.

Quote and escape are both ``"`` on read and on write (Spark's default
escape ``\\`` mis-splits ``"he said ""hi"", ok"``).  The writer keeps
leading/trailing whitespace (Spark trims it by default).  Files are split over
tasks.  Which files have line ends inside quotes is found by one scan of the
text; the records of those are put together from their splits
(``sources.csv_records``), the others go to Spark's split reader.  Callers that
know can pass ``multiline``: False for no such line end (no scan), True for
Spark's whole-file reader (one task a file).  An unquoted empty cell is NULL, a
quoted one the empty string, in both directions.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.schema import RAW_29, STAGING_31
from orderlens.sources.csv_records import files_with_line_ends, records

CORRUPT = "_corrupt_record"
DIALECT = {"sep": ",", "quote": '"', "escape": '"'}
# Reading: the text of a NULL is one that no cell holds, so quoted empty cells stay empty strings.
READ_DIALECT = {**DIALECT, "nullValue": "\u0000", "emptyValue": ""}
# A parser that is asked for some columns only does not see that a record is short.
KEEP_CORRUPT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True,
             multiline: bool | None = None, keep_corrupt: bool = True, **options) -> DataFrame:
    """Read delimited text with a fixed schema (never inferred).

    With ``keep_corrupt`` a ``_corrupt_record`` column holds the text of any
    record whose field count differs from the schema (PERMISSIVE mode)."""
    if keep_corrupt:
        schema, options = _with_corrupt(schema), {**KEEP_CORRUPT, **options}
    options = {**READ_DIALECT, **options}
    broken, plain = files_with_line_ends(spark, path) if multiline is None else ([], [])
    reader = spark.read.options(**options).option("header", header).option("multiLine", bool(multiline)).schema(schema)
    if not broken:
        return reader.csv(path)
    parsed = F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields),
                        {k: str(v) for k, v in {**options, "multiLine": True}.items()})
    whole = records(spark, broken, header).select(parsed.alias("r")).select("r.*")
    return reader.csv(plain).unionByName(whole) if plain else whole


def read_raw_csv(spark: SparkSession, path: str | list[str], multiline: bool | None = None) -> DataFrame:
    """Raw order CSV: 29 STRING columns by position, header row skipped."""
    return read_csv(spark, path, RAW_29, header=True, multiline=multiline)


def read_staging(spark: SparkSession, path: str | list[str], multiline: bool | None = None) -> DataFrame:
    """Clean CSV as the 31-column all-STRING staging table (SQL names)."""
    return read_csv(spark, path, STAGING_31, header=True, multiline=multiline)


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The header row's names exactly as written (duplicates kept)."""
    row = spark.read.options(**DIALECT).option("header", False).csv(path).limit(1).collect()
    return [x for x in row[0]] if row else []


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, header): the names in the first line of each file that is not blank, duplicates kept.

    The lines of each file's first split are scanned, one row a file is shuffled."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("id"))
    first = (lines.where((F.col("block") == 0) & (F.length(F.trim("value")) > 0))
             .groupBy("file").agg(F.min_by("value", "id").alias("line")))
    # each cell with the comma behind it; a quoted one may hold commas and doubled quotes
    cells = F.regexp_extract_all(F.concat("line", F.lit(",")), F.lit(r'("[^"]*+(?:""[^"]*+)*+"|[^,"][^,]*+|),'), 1)
    name = lambda c: F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    return first.select("file", F.transform(cells, name).alias("header"))


def read_csv_with_headers(spark: SparkSession, path: str | list[str], schema: T.StructType, header: list[str],
                          **options) -> DataFrame:
    """``read_csv`` over files of which some begin with ``header`` and some do not.

    The header is left out where it is a file's first record, and only there: a file without one keeps its
    first record, and a record further down that equals the header stays."""
    files = {unquote(r["file"]): list(r["header"]) == list(header) for r in file_headers(spark, path).collect()}
    parts = [read_csv(spark, sorted(f for f, has in files.items() if has == with_header), schema, with_header, **options)
             for with_header in (True, False) if with_header in files.values()]
    if not parts:
        return read_csv(spark, path, schema, **options)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def field_count(text_col) -> "F.Column":
    """Number of fields of a CSV record: separators outside quoted sections + 1.

    The pattern is possessive: it matches without recursion, so a quoted
    section may have any length."""
    unquoted = F.regexp_replace(text_col, r'"[^"]*+(?:""[^"]*+)*+"', "Q")
    return F.size(F.split(unquoted, ",", -1))


def split_rejects(df: DataFrame, min_fields: int = 26) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): records with fewer than ``min_fields`` fields are
    rejected (kept aside, not silently dropped); longer or shorter records
    that still reach ``min_fields`` are accepted with their parsed fields."""
    first = df.columns[0]
    # Spark refuses a scan whose only column is the corrupt record; the
    # coalesce (a no-op under the guard) keeps a data column in every plan.
    text = F.coalesce(F.col(CORRUPT), F.col(first))
    n = F.when(F.col(CORRUPT).isNotNull(), field_count(text))
    tagged = df.withColumn("_fields", n)
    ok = F.col("_fields").isNull() | (F.col("_fields") >= min_fields)
    accepted = tagged.filter(ok).drop("_fields", CORRUPT)
    rejected = tagged.filter(~ok).select(F.col(first).alias("first_field"), F.col(CORRUPT).alias("record"),
                                         F.col("_fields").alias("fields"))
    return accepted, rejected


def skip_header_rows(df: DataFrame, header: list[str]) -> DataFrame:
    """Drop repeated header lines (e.g. from concatenated files): rows that
    equal the header in every column, no others."""
    same = F.lit(True)
    for c, name in zip([c for c in df.columns if c != CORRUPT], header):
        same = same & F.col(c).eqNullSafe(name)
    return df.filter(~same)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """CSV sink: RFC-4180 quoting, whitespace preserved, NULL as empty,
    empty string as ``""``, timestamps as ``yyyy-MM-dd HH:mm:ss`` with a
    fraction only where there is one."""
    df = df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType)
                     else F.col(f"`{f.name}`") for f in df.schema.fields])
    (df.write.mode(mode).options(**DIALECT).option("header", header)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampFormat", TS_TEXT)
     .csv(path))


def write_clean_csv(clean: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The clean table under its CSV headers (31 columns)."""
    from orderlens.operators.clean import to_headers
    write_csv(to_headers(clean), path, header=True, mode=mode)


def from_csv_column(df: DataFrame, col: str, schema: str | T.StructType) -> DataFrame:
    """Parse CSV text held in a column into a struct column ``parsed``."""
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return df.withColumn("parsed", F.from_csv(F.col(col), ddl, DIALECT))
