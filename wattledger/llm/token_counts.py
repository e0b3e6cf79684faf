"""Token counts of whole texts; huge ones are counted in overlapping chunks that many tasks share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm._shared import fingerprint, stored, table

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256


class Counter:
    """Counts tokens by words, as merges never cross them: a word is given to the library once."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # Special strings are single tokens wherever they stand, before words are split.
        self.special = sorted(t.content for t in self.library.get_added_tokens_decoder().values())
        self.split = regex.compile(pattern).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else lambda t: [t]
        self.known: dict[str, int] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) > 500_000:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        self.known.update(zip(new, map(len, self.library.encode_batch_fast(new, add_special_tokens=False)), strict=True))

    def words(self, text: str) -> list[str]:
        parts = self.cut(text)
        if len(parts) == 1:
            return self.split(text)
        return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else self.split(part))]

    def counts(self, words: list[str]) -> list[int]:
        try:
            return [self.known[w] for w in words]
        except KeyError:
            self.learn(set(words))
            return [self.known[w] for w in words]


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    """One for each worker."""
    return Counter(path, pattern)


def _count_short(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(path, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            n = [sum(tool.counts(tool.words(text.as_py() or ""))) for text in texts]
            columns = [*batch.columns[:-1], pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "n_tokens"])

    return run


def _chunks(chunk: int, overlap: int):
    """Chunks of a text from ``chunk`` minus ``overlap`` to the next, the last one shorter."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("start", pa.int64()), ("last", pa.bool_()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b, text = (batch.column(k)[i].as_py() for k in range(3))
                start, last = 0, False
                while not last:
                    last = start + chunk >= len(text)
                    row = [a, b, start, last, text[start : start + chunk]]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types, strict=True)], schema=schema)
                    start += chunk - overlap

    return run


def _encode_chunks(path: str, pattern: str, overlap: int):
    """For each chunk its tokens, and at the word ends of both overlaps the tokens before them."""
    plain = pa.list_(pa.int64())
    names = ["a", "b", "start", "last", "n_tokens", "head", "head_n", "tail", "tail_n"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), plain, plain, plain, plain]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(path, pattern)
        reach = max(map(len, tool.special), default=1)
        for batch in batches:
            for i in range(batch.num_rows):
                a, b, start, last, text = (batch.column(k)[i].as_py() for k in range(5))
                words = tool.words(text)
                at = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
                before = np.concatenate([[0], np.cumsum(tool.counts(words), dtype=np.int64)])
                head = at <= overlap
                # What ends so close to the chunk's end that unseen text could change it proves nothing.
                tail = (at >= len(text) - overlap) & (at <= len(text) - reach) & (at < len(text)) & (at > 0)
                row = [a, b, start, last, int(before[-1]), at[head] + start, before[head], at[tail] + start, before[tail]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v.tolist() if isinstance(v, np.ndarray) else v], t) for v, t in zip(row, types, strict=True)],
                    names=names,
                )

    return run


def _splice(chunks: pa.Table) -> pa.Table:
    """Adds up a text's chunks between places where both chunks of an overlap end a word; null if one has none."""
    rows = sorted(chunks.to_pylist(), key=lambda r: r["start"])
    total, since = 0, 0
    for one, two in zip(rows, rows[1:], strict=False):
        ends, starts = dict(zip(one["tail"], one["tail_n"], strict=True)), dict(zip(two["head"], two["head_n"], strict=True))
        common = ends.keys() & starts.keys()
        if not common:
            total = None
            break
        place = min(common)
        total += ends[place] - since
        since = starts[place]
    if total is not None:
        total += rows[-1]["n_tokens"] - since
    return pa.table({"a": pa.array([rows[0]["a"]]), "b": pa.array([rows[0]["b"]]), "n_tokens": pa.array([total], pa.int64())})


def count_huge(texts: DataFrame, vocabulary: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Columns a, b (naming a distinct text) and n_tokens, for texts given as a, b, text.

    A word end that two chunks share, and that no unseen text behind the first chunk could change, is a
    true one if the first chunk's own start was: words are split from left to right and look at no text
    before them. So both chunks are right on their side of it. A text with an overlap without such a
    place is encoded again with overlaps and chunks eight times as long, until a chunk holds it whole.
    """
    done = []
    while True:
        chunked = texts.mapInArrow(_chunks(chunk, overlap), "a bigint, b bigint, start bigint, last boolean, text string")
        # Also drops the chunks of repeated texts, and deals those of one text to many tasks.
        dealt = chunked.dropDuplicates(["a", "b", "start"])
        ends = "head array<bigint>, head_n array<bigint>, tail array<bigint>, tail_n array<bigint>"
        encoded = dealt.mapInArrow(
            _encode_chunks(vocabulary, pattern, overlap),
            f"a bigint, b bigint, start bigint, last boolean, n_tokens bigint, {ends}",
        )
        spliced = stored(encoded.groupBy("a", "b").applyInArrow(_splice, "a bigint, b bigint, n_tokens bigint"))
        done.append(spliced.where("n_tokens IS NOT NULL"))
        failed = spliced.where("n_tokens IS NULL").select("a", "b")
        if failed.isEmpty():
            break
        texts = texts.join(failed, ["a", "b"], "left_semi")
        chunk, overlap = chunk * 8, overlap * 8
    counted = done[0]
    for more in done[1:]:
        counted = counted.unionByName(more)
    return counted


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    text_col: str = "text",
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """The rows without the text and with ``n_tokens`` (replacing a column of that name).

    ``vocabulary`` is a tokenizer file every machine can open, ``pattern`` the one its pre-tokenizer
    splits words by. A null or empty text has no tokens. Texts of up to ``chunk`` characters are counted
    where they lie, without a shuffle. Longer ones go through ``count_huge``, once for each distinct text.
    """
    kept = [c for c in docs.columns if c not in (text_col, "n_tokens")]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(*kept, text.alias("__text"))
    huge = F.length("__text") > chunk
    schema = base.drop("__text").schema.add("n_tokens", "long")
    short = base.where(~huge).mapInArrow(_count_short(vocabulary, pattern), schema)
    named = base.where(huge).select(*kept, fingerprint(F.col("__text")).alias("__fp"), "__text")
    texts = named.select(F.col("__fp.a").alias("a"), F.col("__fp.b").alias("b"), F.col("__text").alias("text"))
    counts = count_huge(texts, vocabulary, pattern, chunk, overlap).select(F.struct("a", "b").alias("__fp"), "n_tokens")
    return short.unionByName(named.join(counts, "__fp").select(*kept, "n_tokens"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = count_tokens(sized, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
