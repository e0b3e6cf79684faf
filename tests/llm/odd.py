"""Small tables for these operators: odd ones, empty ones, and a part of the test tables."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

#: Names the operators use inside; tables may have columns of these names as well.
CLASHING = (
    "id row a b n fp score label ids n_tokens decoded shard slot size asked vector block bucket words node value blob zone "
    "item items window hash text_col found kept spans start end lines n_lines n_dropped component component_id chunk last place"
).split()


def odd_documents() -> list[tuple]:
    r = random.Random(11)
    words = ["alpha", "Beta", "gamma", "délta", "eps", "zeta,", "eta's", "θ", "iota", "12"]
    prose = lambda n: " ".join(r.choice(words) + r.choice(["", "x", "y", "Z"]) for _ in range(n))
    passage, shared = prose(120), "This line is shared by  many documents."
    docs: list[tuple] = [(1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, "Two words"), (6, "x" * 3000), (7, "ab " * 900)]
    docs += [(None, None), (None, passage), (None, passage), (8, "<|endoftext|> and <|endof"), (9, "\n\n\n"), (10, "'s 've  'll\r\n")]
    for k in range(20, 44):
        lines = [prose(r.randint(1, 30)) for _ in range(r.randint(1, 6))]
        if k % 3 == 0:
            lines.insert(r.randint(0, len(lines)), ["", "  "][k % 2] + (shared if k % 2 else shared.upper()) + "\t")
        if k % 4 == 0:
            lines.append(passage + prose(k % 5))
        docs.append((k, "\n".join(lines)))
    base = prose(90).split(" ")
    for k in range(50, 62):
        edited = list(base)
        for _ in range(k - 50):
            edited[r.randrange(len(edited))] = f"edit{r.randint(0, 99)}"
        docs.append((k, " ".join(edited)))
    docs += [(70, docs[20][1]), (71, docs[20][1]), (71, docs[20][1]), (72, prose(40)), (72, prose(41)), (80, prose(9000))]
    docs += [(81, docs[-1][1] + " tail"), (82, "a tie\na tie\na tie")]
    return docs


def odd_tables() -> dict[str, pa.Table]:
    docs = odd_documents()
    r = random.Random(3)
    base = {
        "doc_id": pa.array([d[0] for d in docs], pa.int64()),
        "text": pa.array([d[1] for d in docs], pa.string()),
        "lang": pa.array([None if k % 5 == 0 else "en" for k in range(len(docs))], pa.string()),
        "source": pa.array(["src0"] * len(docs), pa.string()),
        "n_chars": pa.array([len(d[1] or "") for d in docs], pa.int64()),
    }
    more = {c: pa.array([None if k % 2 else f"{c}{k}" for k in range(len(docs))], pa.string()) for c in CLASHING}
    vectors = [(100 * k, [r.gauss(0, 1) for _ in range(4)]) for k in range(4)]
    vectors += [(k, [r.gauss(0, 1) for _ in range(4)]) for k in range(1, 60)]
    vectors += [(500, [0.0] * 4), (501, None), (502, [1.0, None, 2.0, 3.0]), (503, [1.0, float("nan"), 0.0, 0.0]), (None, [1.0] * 4)]
    vectors += [(600 + k, [1.0, 2.0, 3.0, 4.0]) for k in range(30)] + [(600, [1.0, 2.0, 3.0, 4.0]), (700, [1.0, 2.0]), (701, [2.0, 1.0])]
    items = [(1, docs[30][1][:300]), (2, "one"), (3, None), (4, "--"), (5, docs[30][1][:300]), (None, "two words"), (6, docs[-2][1][:400])]
    items += [(6, docs[-2][1][900:1300]), (7, "eta s alpha"), (8, docs[24][1])]
    labels = [(d[0], (d[0] or 0) % 2, None) for d in docs if d[0] is not None and d[0] > 20] + [(None, 1, 0), (22, None, 1), (99_999, 0, 0)]
    pages = [(1, None, None), (2, "u", ""), (3, "u", "no markup &amp; more"), (4, None, "<p>open <b>bold<p>next"), (4, "u", "<article><p>a</p></article>")]
    named = lambda rows, *fields: {n: pa.array([x[k] for x in rows], t) for k, (n, t) in enumerate(fields)}
    embeddings = named(vectors, ("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())))
    return {
        "documents": pa.table({**base, **more}),
        "embeddings": pa.table({**embeddings, **{c: pa.array(["x"] * len(vectors)) for c in ("asked", "vector", "ids", "row", "shard", "size", "n", "label")}}),
        "benchmark": pa.table({**named(items, ("item_id", pa.int64()), ("text", pa.string())), **{c: pa.array(["x"] * len(items)) for c in ("item", "words", "window", "first", "n")}}),
        "labels": pa.table(named(labels, ("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32()))),
        "pages": pa.table({**named(pages, ("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())), "text": pa.array(["old"] * len(pages)), "n_chars": pa.array([1] * len(pages))}),
    }


def written(tables: dict[str, pa.Table], folder: Path) -> str:
    for name, rows in tables.items():
        pq.write_table(rows, folder / f"{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd_dir(tmp_path_factory):
    return written(odd_tables(), tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    return written({n: t.slice(0, 0) for n, t in odd_tables().items()}, tmp_path_factory.mktemp("empty"))


@pytest.fixture(scope="session")
def documents():
    return odd_documents()
