"""The training-data pipeline: stages over documents, each written and read again by the next.

Every stage takes the session, the documents its predecessor kept and the folder of the tables. All but
the last return the columns they were given. Texts that a stage changes get their ``n_chars`` anew.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm import bpe, decontamination, near_dedup, quality
from wattledger.llm._shared import fingerprint, stored, table
from wattledger.llm.line_dedup import drop_shared_lines

NEAR_WORDS = 5
NEAR_PERCENT = 80


def _marked(docs: DataFrame, found: DataFrame, *columns: str) -> DataFrame:
    """The documents with what an operator found for their id and text."""
    once = found.select(F.col("doc_id").alias("__id"), F.col("fp").alias("__found"), *[F.col(c).alias(f"__{c}") for c in columns])
    named = docs.withColumn("__fp", fingerprint(F.col("text")))
    return named.join(once.distinct(), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__fp") == F.col("__found")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, fitted on the labelled rows that are not held out, rejects."""
    network = quality.fit_on(spark, docs, sf_dir)
    scored = quality.score(docs.withColumn("__scored", F.col("text")), network, "__scored", "__score")
    return scored.where(F.col("__score") >= quality.THRESHOLD).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that three documents or more share from all but one; the documents stay."""
    kept = drop_shared_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group, once where its row repeats; those without an id stay."""
    found = near_dedup.near_duplicates(docs, NEAR_WORDS, NEAR_PERCENT)
    marked = _marked(docs, found, "component_id").where(F.col("doc_id").eqNullSafe(F.col("__component_id")))
    return marked.dropDuplicates(["doc_id", "__fp"]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words a twentieth or more lies in benchmark passages."""
    found = decontamination.find_items(docs, table(spark, sf_dir, "benchmark"))
    marked = _marked(docs, found.withColumn("bad", decontamination.contaminated()), "bad")
    return marked.where(~F.col("__bad")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids (little-endian unsigned 32-bit integers); the text is what they decode to."""
    others = [c for c in docs.columns if c not in ("text", "n_tokens", "ids")]
    encoded = bpe.encode(
        docs.select(F.struct(*others).alias("__row"), "text"), public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, "__row"
    )
    return encoded.select("__row.*", F.col("decoded").cast("string").alias("text"), "n_tokens", "ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

#: The classifier's scores and the token ids are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
