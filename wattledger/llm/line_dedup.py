"""Lines that many documents share are kept in one of them. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm._shared import SPACES, fingerprint, lower_ascii, table

MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    """What makes two lines the same: no white space at either end, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def drop_shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with shared lines dropped, and ``n_lines`` (before) and ``n_dropped`` beside them.

    A line whose key has ``min_chars`` code points and is found in ``min_docs`` documents stays only in the
    largest id that holds it; other lines stay where they are. A null or empty text is one empty line and
    comes back as an empty text. Rows that share an id are one document when documents are counted, and
    each keeps its own lines; a row without id is never counted and never the one that keeps a line.
    Other columns pass through; columns named like the two new ones are replaced.

    Only 128-bit hashes of lines are shuffled by line. Counting combines before it shuffles, and the join
    that marks lines carries no text and may be split where a line is in a large part of all documents.
    The text moves once, by document, as its array of lines, and is put together by position there.
    """
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    row = {"__id": F.col(id_col), "__fp": fingerprint(F.col(text_col))}
    found = (
        docs.select(*[c.alias(n) for n, c in row.items()], F.posexplode(lines).alias("__pos", "__line"))
        .withColumn("__key", line_key(F.col("__line")))
        .where(F.length("__key") >= min_chars)
        .select("__id", "__fp", "__pos", fingerprint(F.col("__key")).alias("__key"))
    )
    shared = (
        found.groupBy("__key")
        .agg(F.count_distinct("__id").alias("__docs"), F.max("__id").alias("__keeper"))
        .where(F.col("__docs") >= min_docs)
        .select("__key", "__keeper")
    )
    dropped = (
        found.join(shared, "__key")
        .where(~F.col("__id").eqNullSafe(F.col("__keeper")))
        .groupBy(F.col("__id").alias("__did"), F.col("__fp").alias("__dfp"))
        .agg(F.collect_set("__pos").alias("__drop"))
    )
    # The lines become an array below the join: above it, the lambda would split the text for every line.
    whole = docs.withColumns(row | {"__lines": lines}).drop(text_col)
    joined = whole.join(dropped, F.col("__id").eqNullSafe(F.col("__did")) & (F.col("__fp") == F.col("__dfp")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))
    kept = F.when(F.col("__drop").isNull(), F.array_join("__lines", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("__lines"), i)), "\n")
    )
    new = {
        text_col: kept,
        "n_lines": F.size("__lines").cast("long"),
        "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long"),
    }
    others = [c for c in docs.columns if c not in new]
    return joined.select(*others, *[c.alias(n) for n, c in new.items()])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM lines
), shared AS (
  SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 20
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (keeper IS NOT NULL AND keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (line_key)
GROUP BY doc_id
"""
