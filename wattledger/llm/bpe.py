"""Byte-level BPE: every distinct word is encoded once, its ids go back to where the word stands."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wattledger.llm._shared import bound_batches, release, table
from wattledger.sources.files import scratch_dir

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BLOCK_CHARS = 16_000_000
SEGMENT_CHARS = 500_000
BATCH_BYTES = 4_000_000


@lru_cache(maxsize=2)
def load(path: str, pattern: str):
    """The encoder of a rank file and its token-byte table, once per worker."""
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoder, {rank: token for token, rank in ranks.items()}


def segments(text: str, size: int) -> Iterator[str]:
    """A text in parts that split into the same words as the whole.

    No word of the pattern holds white space behind another character, so a place between such a
    character and white space always ends a word, whatever surrounds it.
    """
    at = 0
    boundary = regex.compile(r"\S(?=\s)")
    while len(text) - at > size:
        found = boundary.search(text, at + size)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


def _pack_places(places: np.ndarray) -> bytes:
    """Compressed by byte planes, as the high bytes hardly ever change."""
    return zstandard.compress(places.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpack_places(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _word_blocks(pattern: str, block_chars: int, segment_chars: int, buckets: int):
    """One row for each block of texts: its distinct words by bucket, and of each text the places in that list."""
    listed = pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary()), ("places", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        task, block, row = TaskContext.get().partitionId() << 32, 0, 0
        words: dict[str, int] = {}
        rows: list[dict] = []
        chars = 0

        def flush() -> pa.RecordBatch:
            encoded = [w.encode() for w in words]
            bucket = np.array([crc32(w) % buckets for w in encoded])
            order = np.argsort(bucket, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []
            dealt = [
                {
                    "bucket": int(bucket[part[0]]),
                    "words": zstandard.compress(
                        np.array([len(encoded[j]) for j in part], "<u4").tobytes() + b"".join(encoded[j] for j in part), 3
                    ),
                    "places": _pack_places(np.diff(part, prepend=0)),
                }
                for part in parts
            ]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task + block], pa.int64()),
                    pa.array([any(r["piece"] or not r["last"] for r in rows)]),
                    pa.array([dealt], listed),
                    pa.array([rows], pa.list_(stored_row)),
                ],
                names=["block", "cut", "words", "texts"],
            )

        for batch in batches:
            ids = batch.column(0)
            stored_row = pa.struct(
                [("id", ids.type), ("row", pa.int64()), ("piece", pa.int32()), ("last", pa.bool_()), ("places", pa.binary())]
            )
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                parts = segments(text, segment_chars)
                part, piece = next(parts), 0
                while part is not None:
                    places = np.array([words.setdefault(w, len(words)) for w in split(part)], np.uint32)
                    following = next(parts, None)
                    rows.append(
                        {"id": ids[i].as_py(), "row": task + row, "piece": piece, "last": following is None, "places": _pack_places(places)}
                    )
                    chars += len(part) + 40
                    if chars >= block_chars:
                        yield flush()
                        words, rows, chars, block = {}, [], 0, block + 1
                    part, piece = following, piece + 1
                row += 1
        if rows:
            yield flush()
        del words, rows
        release()

    return run


def _encode_words(path: str, pattern: str):
    """A block's words of one bucket become their numbers of tokens and their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = load(path, pattern)
        known: dict[bytes, tuple[int, bytes]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                packed, n = zstandard.decompress(batch.column(1)[i].as_py()), len(_unpack_places(batch.column(2)[i].as_py()))
                ends = np.cumsum(np.frombuffer(packed, "<u4", n)) + 4 * n
                words = [packed[a:b] for a, b in zip([4 * n, *ends[:-1]], ends, strict=True)]
                if len(known) > 500_000:
                    known.clear()
                new = [w for w in words if w not in known]
                for word, ids in zip(new, encoder.encode_ordinary_batch([w.decode() for w in new], num_threads=1), strict=True):
                    known[word] = len(ids), np.array(ids, "<u4").tobytes()
                counts = np.array([known[w][0] for w in words], np.uint32)
                ids = np.frombuffer(b"".join(known[w][1] for w in words), "<u4")
                row = [batch.column(0)[i].as_py(), batch.column(2)[i].as_py(), _pack_places(counts), _pack_places(ids)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, [pa.int64(), *[pa.binary()] * 3], strict=True)],
                    names=["block", "places", "counts", "ids"],
                )
        del known
        release()

    return run


def _reassemble(path: str, pattern: str, id_kind: pa.DataType):
    """Ids and decoded bytes of each piece of text in a block, from the block's words and their ids."""

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        _, token_bytes = load(path, pattern)
        join = lambda column, of: np.concatenate([np.zeros(0, np.uint32), *map(of, words.column(column).to_pylist())])
        places = join("places", lambda v: np.cumsum(_unpack_places(v), dtype=np.uint32))
        counts, flat = join("counts", _unpack_places).astype(np.int64), join("ids", _unpack_places)
        start_of, count_of = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        start_of[places], count_of[places] = np.cumsum(counts) - counts, counts
        batches, out, size = [], {n: [] for n in ("id", "row", "piece", "last", "n_tokens", "ids", "decoded")}, 0
        kinds = [id_kind, pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

        for held in texts.column("texts"):
            for text in held:
                at = _unpack_places(text["places"].as_py())
                n = count_of[at]
                ends = np.cumsum(n)
                ids = flat[np.repeat(start_of[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
                decoded = b"".join(map(token_bytes.__getitem__, ids.tolist()))
                row = [*(text[c].as_py() for c in ("id", "row", "piece", "last")), len(ids), ids.tobytes(), decoded]
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
                size += 4 * len(ids) + len(decoded)
                if size >= BATCH_BYTES:
                    batches.append(flush())
                    out, size = {n: [] for n in out}, 0
        batches.append(flush())
        del out, places, counts, flat, start_of, count_of
        release()
        return pa.Table.from_batches(batches)

    return run


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """One row per document: ``id_col``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and
    ``decoded`` (the bytes the ids stand for). A null or empty text has no tokens. Rows that repeat an id
    come back as often; an id may be null. Columns other than the two named are not read.

    ``vocabulary`` is a rank file every machine can open; ``pattern`` splits a text into words, and each
    is encoded by itself.

    The words of a block of texts are listed once, and a text is the list of its words' places. All
    blocks' words are shuffled by a hash of the word, those of one block and hash bucket packed together,
    so a word is encoded in one task for the whole corpus. The ids go back to the block, where each text
    is put together by position and decoded through the token-byte table. A common word is shuffled once
    for each block, not for each occurrence. Blocks are stored bucketed by their number: the lists of
    places, most of the volume, are not shuffled. A text larger than a block is cut between words and its
    parts are joined at the end. ``segment_chars`` is what is split into words at a time.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema[id_col].dataType
    numbers = [("row", T.LongType()), ("piece", T.IntegerType()), ("last", T.BooleanType())]
    text = _struct([("id", id_type), *numbers, ("places", T.BinaryType())])
    dealt = _struct([("bucket", T.IntegerType()), ("words", T.BinaryType()), ("places", T.BinaryType())])
    blocks = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _word_blocks(pattern, block_chars, segment_chars, 2 * buckets),
        _struct([("block", T.LongType()), ("cut", T.BooleanType()), ("words", T.ArrayType(dealt)), ("texts", T.ArrayType(text))]),
    )
    name = f"wattledger_words_{uuid.uuid4().hex}"
    path = scratch_dir(spark)
    writer = blocks.write.bucketBy(buckets, "block").option("compression", "zstd").option("path", path)
    writer.format("parquet").saveAsTable(name)
    listed = spark.table(name)
    # Only its name: the files stay, and the plan knows them and their buckets.
    spark.sql(f"DROP TABLE {name}")
    result = _struct([("id", id_type), *numbers, ("n_tokens", T.LongType()), ("ids", T.BinaryType()), ("decoded", T.BinaryType())])

    def pieces(blocks: DataFrame) -> DataFrame:
        words = (
            blocks.select("block", F.inline("words"))
            .repartition("bucket")
            .select("block", "words", "places")
            .mapInArrow(_encode_words(vocabulary, pattern), "block bigint, places binary, counts binary, ids binary")
        )
        texts = blocks.select("block", "texts").groupBy("block").cogroup(words.groupBy("block"))
        return texts.applyInArrow(_reassemble(vocabulary, pattern, to_arrow_type(id_type)), result)

    whole = pieces(listed).where("piece = 0 AND last").drop(*[n for n, _ in numbers])
    # Blocks say whether they hold a cut text, so that only those few are put together a second time.
    cut = pieces(listed.where("cut")).where("NOT (piece = 0 AND last)").groupBy("row").applyInArrow(_joined, whole.schema)
    return whole.unionByName(cut).withColumnRenamed("id", id_col)


def _joined(pieces: pa.Table) -> pa.Table:
    """One row of the pieces of a text."""
    pieces = pieces.sort_by("piece")
    whole = {n: b"".join(pieces.column(n).to_pylist()) for n in ("ids", "decoded")}
    rows = [pieces.column("id").slice(0, 1).combine_chunks(), pa.array([sum(pieces.column("n_tokens").to_pylist())], pa.int64())]
    return pa.table([*rows, *[pa.array([v], pa.binary()) for v in whole.values()]], names=["id", "n_tokens", *whole])


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoded = encode(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
    )
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
