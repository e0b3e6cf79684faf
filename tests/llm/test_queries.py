"""The registered queries over odd and empty tables, against brute force."""

from __future__ import annotations

import base64
import os
from collections import Counter

import brute
import public_tokenizers
import pytest
import tiktoken
from odd import documents, empty_dir, odd_dir, odd_tables  # noqa: F401 (fixtures)
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wattledger.llm import bpe, catalog, near_dedup, quality, secret_scan, token_counts
from wattledger.llm._shared import table

QUERIES = catalog.queries()
SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")


def encoder():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(df, columns, want):
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    assert got - Counter(want) == Counter() and Counter(want) - got == Counter()


def items():
    rows = odd_tables()["benchmark"].select(["item_id", "text"]).to_pylist()
    return [(r["item_id"], r["text"]) for r in rows]


def test_line_dedup(spark, odd_dir, documents):
    df = QUERIES["op1_line_dedup"](spark, odd_dir)
    same(df, ["doc_id", "n_lines", "n_dropped", "kept_sha256"], brute.line_dedup(documents))


def test_near_dedup(spark, odd_dir, documents):
    df = QUERIES["op2_near_dedup"](spark, odd_dir)
    same(df, ["doc_id", "n_shingles", "component_id", "kept"], brute.near_dedup(documents))


def test_near_dedup_by_full_sets(spark, odd_dir, documents):
    found = near_dedup.near_duplicates(table(spark, odd_dir, "documents"), 3, 85, k=None)
    df = found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    same(df, ["doc_id", "n_shingles", "component_id", "kept"], brute.near_dedup(documents))


def test_suffix_dedup(spark, odd_dir, documents):
    df = QUERIES["op4_suffix_dedup"](spark, odd_dir)
    same(df, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.suffix_dedup(documents))


def test_neighbours(spark, odd_dir):
    rows = odd_tables()["embeddings"].select(["vec_id", "embedding"]).to_pylist()
    want = brute.neighbours([(r["vec_id"], r["embedding"]) for r in rows])
    got: dict = {}
    for r in sorted(QUERIES["op5_neighbours"](spark, odd_dir).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    assert set(got) == set(want)
    for query, near in want.items():
        # So few vectors that every one is found.
        assert [i for _, i in got[query]] == [i for _, i in near]
        assert [s for s, _ in got[query]] == pytest.approx([s for s, _ in near])


def test_bpe(spark, odd_dir, documents):
    df = QUERIES["op7_bpe"](spark, odd_dir)
    same(df, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], brute.encode(documents, encoder()))


def test_token_counts(spark, odd_dir, documents):
    df = QUERIES["op8_token_counts"](spark, odd_dir)
    library = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    same(df, ["doc_id", "n_bytes", "n_tokens", "over_limit"], brute.count_tokens(documents, library))


def test_sharding(spark, odd_dir, documents):
    df = QUERIES["op9_sharding"](spark, odd_dir)
    same(df, ["doc_id", "size", "text_crc32", "law", "shard", "grown_shard"], brute.sharded(documents))
    by_shard: dict = {}
    for r in df.collect():
        by_shard.setdefault(r.shard, []).append(((r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"]), r.slot))
    for rows in by_shard.values():
        assert [slot for _, slot in sorted(rows)] == list(range(len(rows)))


def test_decontamination(spark, odd_dir, documents):
    df = QUERIES["op10_decontamination"](spark, odd_dir)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute.decontaminate(documents, items())
    assert any(w[5] for w in want)
    same(df, columns, want)


def test_lexical_search(spark, odd_dir, documents):
    df = QUERIES["op11_lexical_search"](spark, odd_dir)
    same(df, ["item_id", "rank", "doc_id", "score"], brute.rank_documents(documents, items()))


def test_whitening(spark, odd_dir):
    rows = odd_tables()["embeddings"].select(["vec_id", "embedding"]).to_pylist()
    want = brute.whiten([(r["vec_id"], r["embedding"]) for r in rows])
    got = QUERIES["op12_whitening"](spark, odd_dir).collect()
    assert Counter((r.vec_id, r.component, r.n, r.deviation) for r in got) == Counter(w[:4] for w in want)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for c in {r.component for r in got}:
        mine = {r.vec_id: r.whitened for r in got if r.component == c}
        theirs = {w[0]: w[4] for w in want if w[1] == c}
        sign = 1 if sum(mine[i] * theirs[i] for i in mine) > 0 else -1
        assert all(mine[i] == pytest.approx(sign * theirs[i], abs=1e-9) for i in mine)
        shares = {r.explained for r in got if r.component == c}
        assert len(shares) == 1 and shares.pop() == pytest.approx(next(w[5] for w in want if w[1] == c), rel=1e-9)


def test_secret_scan(spark, odd_dir, documents):
    df = QUERIES["op13_secret_scan"](spark, odd_dir)
    classes = [(c.kind, c.alphabet, c.window, c.least_bits) for c in secret_scan.CLASSES]
    same(df, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"], brute.secrets(documents, classes, secret_scan.ALLOWED))


def test_quality_of_odd_rows(spark, odd_dir, documents):
    got = QUERIES["op3_quality"](spark, odd_dir).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in documents)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    scores: dict = {}
    for r, text in zip(got, [t for _, t in documents], strict=True):
        scores.setdefault(text or "", set()).add(r.score)
    assert all(len(s) == 1 for s in scores.values())
    network = quality.fit_on(spark, spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text"), odd_dir)
    assert len({s for found in scores.values() for s in found}) > 5
    for text, (score,) in scores.items():
        assert score == pytest.approx(brute.quality(network, text), abs=1e-5)


def test_extraction_of_odd_rows(spark, odd_dir):
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in QUERIES["op6_html_extraction"](spark, odd_dir).collect())
    assert {r[0] for r in got} == {1, 2, 3, 4} and sum(got.values()) == 5
    assert got[(1, None, "", 0)] == got[(2, "u", "", 0)] == got[(4, "u", "a", 1)] == 1
    assert all(n == len(text) for _, _, text, n in got)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


def test_pipeline_of_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


@pytest.mark.parametrize("folder", ["odd", "sf"])
def test_pipeline_by_brute_force(spark, odd_dir, folder):
    """Every stage against a plain version of it, over what its predecessor kept."""
    sf_dir = odd_dir if folder == "odd" else SF_DIR
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    docs = corpus_pipeline.table(spark, sf_dir, "documents")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    plain = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before, columns = plain(docs), docs.columns
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir))
        after = Counter(plain(docs))
        if name == "quality classifier":
            network = quality.fit_on(spark, corpus_pipeline.table(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
            scores = {text: brute.quality(network, text) for _, text in before}
            # Plain sums are of doubles; a score that close to the limit may fall to either side.
            sure = Counter(d for d in before if scores[d[1]] >= 0.7 + 1e-5)
            assert after and not sure - after and not after - Counter(d for d in before if scores[d[1]] >= 0.7 - 1e-5)
        elif name == "line dedup":
            assert Counter((i, brute.sha(t)) for i, t in after.elements()) == Counter((w[0], w[3]) for w in brute.line_dedup(before))
            assert docs.where("n_chars <> length(text)").isEmpty()
        elif name == "MinHash near-dedup":
            kept = {(i, t) for (i, t), w in zip(before, brute.near_dedup(before, 5, 80), strict=True) if w[3]}
            assert after == Counter(kept)
        elif name == "benchmark decontamination":
            assert after == Counter(d for d, w in zip(before, brute.decontaminate(before, bench), strict=True) if not w[5])
        else:
            want = brute.encode(before, encoder())
            got = [(r.doc_id, r.n_tokens, brute.sha(bytes(r.ids)), brute.sha(r.text)) for r in docs.collect()]
            assert Counter(got) == Counter(want)
        if name != "byte-level BPE":
            assert docs.columns == columns
