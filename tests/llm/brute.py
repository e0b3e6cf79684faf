"""Plain versions of the registered queries over lists of rows, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def line_dedup(docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingles(text, n):
    words = re.findall(SPACED, (text or "").translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def near_dedup(docs, n=3, percent=85):
    nodes = sorted({(i, text or "") for i, text in docs if i is not None})
    sets = {node: shingles(node[1], n) for node in nodes}
    parent = {node: node for node in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, x in enumerate(nodes):
        for y in nodes[k + 1 :]:
            common = len(sets[x] & sets[y])
            if sets[x] and 100 * common >= percent * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    first = lambda i, text: find((i, text or ""))[0] if i is not None else None
    return [(i, len(shingles(text, n)), first(i, text), first(i, text) == i) for i, text in docs]


def suffix_dedup(docs, length=400):
    texts = [(i, (text or "").encode()) for i, text in docs]
    starts = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        covered = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if starts[b[s : s + length]] > 1:
                covered[s : s + length] = True
        runs = int((np.diff(covered.astype(int), prepend=0) == 1).sum())
        kept = bytes(x for x, c in zip(b, covered, strict=False) if not c)
        out.append((i, len(b), int(covered.sum()), runs, sha(kept)))
    return out


def neighbours(vectors, k=10):
    good = [(i, v) for i, v in vectors if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = {}
    for q, at in good:
        if q % 100 == 0:
            near = sorted({(math.dist(np.float64(at), np.float64(v)), i) for i, v in good if i != q and len(v) == len(at)})
            out[q] = near[:k]
    return out


def encode(docs, encoder):
    out = []
    for i, text in docs:
        ids = encoder.encode_ordinary(text or "")
        out.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text or "")))
    return out


def count_tokens(docs, library):
    lengths = [(i, text or "", len(library.encode(text or "", add_special_tokens=False))) for i, text in docs]
    return [(i, len(text.encode()), n, n > 512) for i, text, n in lengths]


def draw(i, shard):
    name = "null" if i is None else str(i)
    return (int(hashlib.md5(f"{name}:{shard}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def shard_of(i, weights):
    return max(range(len(weights)), key=lambda s: (-weights[s] / math.log(draw(i, s)), -s))


def sharded(docs):
    """Without the slot."""
    size = lambda text: len((text or "").encode()) + 1
    crc = lambda text: zlib.crc32((text or "").encode())
    return [(i, size(t), crc(t), "key", shard_of(i, [1.0] * 16), shard_of(i, [1.0] * 17)) for i, t in docs]


def decontaminate(docs, items, window=13):
    split = lambda text: re.findall(ALNUM, (text or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        words = split(text)
        for s in range(max(len(words) - window + 1, 1) if words else 0):
            windows[tuple(words[s : s + window])].add("null" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        words = split(text)
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(words) - n + 1):
                if held := windows.get(tuple(words[s : s + n])):
                    hit.update(range(s, s + n))
                    found |= held
        bad = bool(hit) and 20 * len(hit) >= len(words)
        out.append((i, len(words), len(hit), len(found), sha(",".join(sorted(found))), bad))
    return out


TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def rank_documents(docs, items, top=10):
    split = lambda text: re.findall(TERMS, (text or "").translate(LOWER))
    rows = [(i, Counter(split(text)), len(split(text))) for i, text in docs]
    n_docs, n_words = sum(n > 0 for _, _, n in rows), sum(n for _, _, n in rows)
    df = Counter(t for _, tf, _ in rows for t in tf)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, tf, n in rows:
            m = 25 + (75 * n * n_docs) // n_words
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in split(text) if t in tf)
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return out


def whiten(vectors, components=8):
    """Whitened entries up to their sign, by the library's eigenvectors."""
    good = [(i, v) for i, v in vectors if v and None not in v and all(map(math.isfinite, v))]
    size = Counter(len(v) for _, v in good).most_common(1)[0][0]
    good = [(i, v) for i, v in good if len(v) == size]
    x = np.floor(1024 * np.array([v for _, v in good], np.float64)).astype(np.int64) + 100_000
    n = len(x)
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    z = x - x.sum(axis=0) / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    white = z @ u / np.sqrt(e)
    share = e / (z * z).sum() * n
    return [(i, c + 1, n, int(deviation[k]), white[k, c], share[c]) for k, (i, _) in enumerate(good) for c in range(len(e))]


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(docs, classes, allowed):
    kinds = ["assign", "access", "hex", *[c[0] for c in classes]]
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda s: (s[0], kinds.index(s[1]))))
    out = []
    for i, text in docs:
        text = text or ""
        base = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        base += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        base += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        more = []
        for kind, alphabet, window, bits in classes:
            for m in re.finditer(f"[{re.escape(alphabet)}]+", text):
                if any(re.search(a, m[0]) for a in allowed):
                    continue
                covered = set()
                for s in range(len(m[0]) - window + 1):
                    counts = Counter(m[0][s : s + window]).values()
                    if -sum(c / window * math.log2(c / window) for c in counts) >= bits:
                        covered |= set(range(m.start() + s, m.start() + s + window))
                starts = sorted(p for p in covered if p - 1 not in covered)
                ends = sorted(p + 1 for p in covered if p + 1 not in covered)
                more += [(a, kind, b) for a, b in zip(starts, ends, strict=True)]
        more = [s for s in more if not any(a <= s[0] and b >= s[2] for a, _, b in base)]
        count = Counter(k for _, k, _ in base)
        out.append((i, *[count[k] for k in kinds[:3]], sha(joined(base)), joined(base + more)))
    return out


def quality(network, text, chunk=256, step=128, block=64):
    """The network's score by plain sums over bytes; a text is filled up to whole blocks with zero bytes."""
    data = (text or "").encode()
    places = max(1, -(-len(data) // block)) * block
    width = len(network.filters)
    byte = data + bytes(places + width - len(data))
    value = [sum(network.filters[k][byte[p + k]].astype(float) for k in range(width)) for p in range(places)]
    starts = range(0, max(len(data) - step, 1), step)
    pooled = np.array([np.maximum(np.max(value[s : s + chunk], axis=0) + network.bias, 0) for s in starts])
    z = np.concatenate([pooled.mean(axis=0), pooled.max(axis=0)]) @ network.weights + network.offset
    return 1 / (1 + math.exp(-z))
