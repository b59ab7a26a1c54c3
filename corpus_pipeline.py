"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
their own columns; the last returns the encoded texts.  ``run`` writes every
stage's result as Parquet to the shared folder and rereads it.

Defined cases: those of the operators.  Rows with one id and different texts
are different documents in every stage; of rows equal in id and text one stays
behind the exact stage.  A document that the exact or near stage keeps is found
again by id and text hash, nulls included, never by id alone.  Copies with one id
and text are brought to one row by each task before they are shuffled.  Columns of
any name pass through: what a stage adds has a name that the documents have not.
Very long texts are read whole; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontaminate, exact_dedup, langid, pieces, simhash
from orderlens.llm.common import ascii_lower, table
from orderlens.plans.materialize import materialize

#: Below this pooled probability of the best language a text counts as rejected.
MIN_LANGUAGE_SCORE = 0.3


def _row_key(text_hash: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_hash.cast("string"))


def _keep(docs: DataFrame, text_hash: Column, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is in ``kept``, one of each key.

    Partial aggregation leaves a task one row a key, so a key that a third of all rows share is no large group."""
    rows = docs.select(_row_key(text_hash).alias("key"), F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    single = rows.groupBy("key").agg(F.max_by("doc", F.coalesce("doc.text", F.lit(""))).alias("doc"))
    return single.join(kept, "key", "left_semi").select("doc.*")


def _new(docs: DataFrame, stem: str) -> str:
    """A column name that the documents have not."""
    taken = {c.lower() for c in docs.columns}
    return next(n for n in (f"{stem}{'_' * k}" for k in range(len(taken) + 1)) if n not in taken)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter and a language that the network recognises."""
    lang, score = _new(docs, "found_lang"), _new(docs, "found_score")
    found = langid.identify(docs, langid.learned(docs), names=(lang, score))
    return found.where((F.col(lang) != "und") & (F.col(score) >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest id."""
    kept = exact_dedup.content_sort_dedup(docs, keep="largest").where("kept")
    norm = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    return _keep(docs, F.sha2(F.encode(norm, "UTF-8"), 256),
                 kept.select(_row_key(F.col("text_sha256")).alias("key")))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the smallest id (nulls last), then text hash."""
    # a row for each root: ids do not tell components apart where they are null or repeated
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    kept = simhash.near_duplicates(docs).groupBy("root").agg(F.min(place).alias("first"))
    kept = kept.select("first.doc_id", "first.text_hash")
    return _keep(docs, F.xxhash64("text"), kept.select(_row_key(F.col("text_hash")).alias("key")))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    hits = _new(docs, "hits")
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"), name=hits)
    return found.where(F.size(hits) == 0).select(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled segmentations of each document, decoded again as a check."""
    return pieces.encode_samples(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("sentencepiece", encode_stage),
]

#: A trained network and sampled segmentations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
