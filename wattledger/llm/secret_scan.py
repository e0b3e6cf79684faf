"""Secrets in texts: key assignments and known shapes, and windows of high entropy. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm._shared import table


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The shapes looked for and the length that each must have. Kinds are listed in this order.
ASSIGN = (
    f"({'|'.join(map(_either_case, ('password', 'passwd', 'secret', 'token', 'api_?key')))})"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_CHARS = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sums of n log2 n are kept as integers of this many parts, so that a million steps add no error.
SCALE = 2**20


@dataclass(frozen=True)
class CharClass:
    """Runs of these characters, a window long or longer, are candidates; a window counts from ``least_bits`` on."""

    kind: str
    alphabet: str
    window: int
    least_bits: float

    @property
    def pattern(self) -> str:
        """A minus sign comes last in an alphabet."""
        return f"[{self.alphabet}]{{{self.window},}}"

    @property
    def most(self) -> int:
        """The largest sum of n log2 n over the characters of a window with that entropy."""
        return math.floor(self.window * (math.log2(self.window) - self.least_bits) * SCALE)

    @property
    def sums(self) -> list[int]:
        """n log2 n for each count a character can have in a window."""
        return [round(n * math.log2(n) * SCALE) if n else 0 for n in range(self.window + 1)]


CLASSES = (
    CharClass("hex_entropy", DIGITS + "ABCDEFabcdef", 24, 3.0),
    CharClass("base64_entropy", DIGITS + UPPER + LOWER + "+/_=-", 24, 4.0),
)

#: Candidates that are no secrets: without a digit (words, names, paths), without a letter (dates, numbers,
#: rulers), UUIDs, and checksums that say so.
ALLOWED = (
    "^[A-Za-z+/_=-]+$",
    "^[0-9+/_=-]+$",
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    "^(md5|sha1|sha256|sha384|sha512)[-=]",
)

_FOUND = "array<struct<start:int,end:int,found:string>>"
_SPANS = "array<struct<start:int,end:int>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _span(start: Column, end: Column, *more: Column) -> Column:
    return F.array(F.struct(start.alias("start"), end.alias("end"), *more))


def _matches(text: Column, pattern: str) -> Column:
    """The matches with their places in code points.

    Spark gives matches and what lies between them, but no places; those are running sums of lengths.
    """

    def placed(found: Column, between: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            one = F.get(found, i)
            start = state["at"] + F.length(F.get(between, i))
            end = start + F.length(one)
            return F.struct(end.alias("at"), F.concat(state["out"], _span(start, end, one.alias("found"))).alias("out"))

        first = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), first, step, lambda state: state["out"])

    def any_of(found: Column) -> Column:
        split = _let(F.split(text, pattern, -1), lambda between: placed(found, between))
        return F.when(F.size(found) > 0, split).otherwise(F.array().cast(_FOUND))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), any_of)


def _high_windows(run: Column, of: CharClass) -> Column:
    """What windows of high entropy cover of a run; covers that overlap or touch are one.

    The window moves on by a character: the count of the one that leaves falls, that of the one that enters
    rises, and the sum of n log2 n changes by these two steps alone.
    """
    w, sums = of.window, of.sums
    steps = F.array(*[F.lit(b - a).cast("long") for a, b in zip(sums, sums[1:], strict=False)])

    def closed(state: Column) -> Column:
        return F.when(state["start"] >= 0, F.concat(state["out"], _span(state["start"], state["end"]))).otherwise(state["out"])

    def slid(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            enters, full = F.get(codes, i), i >= w
            leaves = F.when(full, F.get(codes, i - w)).otherwise(-1)
            counts = F.transform(
                state["counts"], lambda n, k: n + F.when(k == enters, 1).otherwise(0) - F.when(k == leaves, 1).otherwise(0)
            )
            fewer = F.when(full, F.get(steps, F.get(state["counts"], leaves) - 1)).otherwise(F.lit(0).cast("long"))
            more = F.get(steps, F.get(state["counts"], enters) - F.when(leaves == enters, 1).otherwise(0))
            return F.struct(
                counts.alias("counts"),
                (state["total"] - fewer + more).alias("total"),
                state["start"].alias("start"),
                state["end"].alias("end"),
                state["out"].alias("out"),
            )

        def marked(state: Column, i: Column) -> Column:
            start, end = i - (w - 1), i + 1
            high = (start >= 0) & (state["total"] <= of.most)
            goes_on = (state["start"] >= 0) & (start <= state["end"])
            return F.struct(
                state["counts"].alias("counts"),
                state["total"].alias("total"),
                F.when(high & ~goes_on, start).otherwise(state["start"]).alias("start"),
                F.when(high, end).otherwise(state["end"]).alias("end"),
                F.when(high & ~goes_on, closed(state)).otherwise(state["out"]).alias("out"),
            )

        first = F.struct(
            F.array_repeat(F.lit(0), len(of.alphabet)).alias("counts"),
            F.lit(0).cast("long").alias("total"),
            F.lit(-1).alias("start"),
            F.lit(-1).alias("end"),
            F.array().cast(_SPANS).alias("out"),
        )
        both = lambda state, i: _let(step(state, i), lambda moved: marked(moved, i))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), first, both, closed)

    return _let(F.transform(F.split(run, "", -1), lambda c: F.instr(F.lit(of.alphabet), c) - 1), slid)


def _kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _in_order(spans: Column, kinds: Sequence[str]) -> Column:
    """By start, then kind as listed."""
    ranks = F.array(*[F.lit(k) for k in kinds])
    ranked = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(ranks, s["kind"]), s["kind"].alias("kind"), s["end"]))
    return F.transform(
        F.array_sort(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def base_spans(text: Column) -> dict[str, Column]:
    """Places of each base kind, leftmost and not overlapping; ``found`` is the text there."""
    value = lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2))
    return {
        "assign": F.filter(_matches(text, ASSIGN), lambda m: value(m) >= ASSIGN_CHARS),
        "access": _matches(text, ACCESS),
        "hex": _matches(text, HEX),
    }


def entropy_spans(text: Column, of: CharClass, allowed: Sequence[str] = ALLOWED) -> Column:
    """Places of high entropy in the runs of a class that the allow-list does not name."""
    harmless = lambda m: reduce(Column.__or__, [m["found"].rlike(a) for a in allowed], F.lit(False))
    runs = F.filter(_matches(text, of.pattern), lambda m: ~harmless(m))
    moved = F.transform(
        runs,
        lambda m: F.transform(
            _high_windows(m["found"], of), lambda s: F.struct((s["start"] + m["start"]).alias("start"), (s["end"] + m["start"]).alias("end"))
        ),
    )
    return F.flatten(moved)


def find_secrets(
    docs: DataFrame, text_col: str = "text", classes: Sequence[CharClass] = CLASSES, allowed: Sequence[str] = ALLOWED
) -> DataFrame:
    """The rows with ``base`` and ``secrets``: arrays of kind, start and end (code points, end exclusive).

    ``base`` holds the known shapes: assignments, access keys and hexadecimal runs. ``secrets`` adds to them
    what windows of high entropy cover, for each class of characters, where no base span holds it whole. Both
    are in order of start, then kind. A null or empty text has none. Rows are taken one by one: ids may be
    null or repeat, and no row is moved. Other columns pass through; columns named like the two new ones are
    replaced. A text is held whole with its candidates, a run costs a fixed amount for each character, and
    only the spans found grow with a text.
    """
    kinds = [*BASE_KINDS, *[c.kind for c in classes]]
    text = F.coalesce(F.col("__text").cast("string"), F.lit(""))
    others = [c for c in docs.columns if c not in ("base", "secrets")]
    given = docs.select(F.col(text_col).alias("__text"), *[F.col(c) for c in others])
    base = F.concat(*[_kind(spans, kind) for kind, spans in base_spans(text).items()])
    more = [_kind(entropy_spans(text, c, allowed), c.kind) for c in classes]

    def joined(base: Column) -> Column:
        inside = lambda s: F.exists(base, lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
        added = F.filter(F.concat(*more), lambda s: ~inside(s)) if more else base
        every = F.concat(base, added) if more else base
        return F.struct(_in_order(base, kinds).alias("base"), _in_order(every, kinds).alias("secrets"))

    return given.withColumn("__found", _let(base, joined)).select(*others, "__found.base", "__found.secrets")


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "base", "secrets")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in BASE_KINDS], F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"), joined_spans(F.col("secrets")).alias("spans")
    )


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_matches(kind: str, pattern: str) -> str:
    return f"""
    SELECT rid, {_sql_text(kind)} AS kind, found, CAST(before + gap AS BIGINT) AS start, CAST(before + gap + length(found) AS BIGINT) AS stop
    FROM (SELECT rid, nth, found, sum(length(gap)) OVER w AS gap,
                 coalesce(sum(length(found)) OVER (PARTITION BY rid ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM (SELECT rid, unnest(found) AS found, unnest(gaps[:len(found)]) AS gap, generate_subscripts(found, 1) AS nth
                FROM (SELECT rid, regexp_extract_all(text, {_sql_text(pattern)}) AS found,
                             string_split_regex(text, {_sql_text(pattern)}) AS gaps FROM texts) split) listed
          WINDOW w AS (PARTITION BY rid ORDER BY nth)) placed"""


def _sql_class(of: CharClass) -> str:
    harmless = " OR ".join(f"regexp_matches(found, {_sql_text(a)})" for a in ALLOWED)
    sums = ", ".join(f"({n}, {s})" for n, s in enumerate(of.sums))
    return f"""
    SELECT rid, {_sql_text(of.kind)} AS kind, start, stop FROM (
      SELECT rid, min(first) AS start, max(first) + {of.window} AS stop FROM (
        SELECT rid, run, first, sum(fresh) OVER (PARTITION BY rid, run ORDER BY first) AS island FROM (
          SELECT rid, run, first, CASE WHEN first - lag(first) OVER (PARTITION BY rid, run ORDER BY first) <= {of.window} THEN 0 ELSE 1 END AS fresh
          FROM (SELECT rid, run, first FROM (
                  SELECT rid, run, first, c, count(*) AS n
                  FROM (SELECT rid, run, first, substr(found, first - run + k + 1, 1) AS c
                        FROM (SELECT rid, start AS run, found, unnest(range(start, stop - {of.window} + 1)) AS first
                              FROM ({_sql_matches(of.kind, of.pattern)}) runs WHERE NOT ({harmless})) windows,
                             range({of.window}) places(k)) chars
                  GROUP BY 1, 2, 3, 4) counted
                JOIN (VALUES {sums}) sums(n, part) USING (n)
                GROUP BY 1, 2, 3 HAVING sum(part) <= {of.most}) high) marked) islands
      GROUP BY rid, run, island) covers"""


def _sql_joined(spans: str, kinds: Sequence[str]) -> str:
    rank = f"list_position([{', '.join(map(_sql_text, kinds))}], kind)"
    return f"SELECT rid, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, {rank}) AS joined FROM {spans} GROUP BY rid"


_KINDS = [*BASE_KINDS, *[c.kind for c in CLASSES]]
ORACLE = f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
base AS (
  SELECT rid, kind, start, stop
  FROM ({" UNION ALL ".join(f"({_sql_matches(k, p)})" for k, p in zip(BASE_KINDS, (ASSIGN, ACCESS, HEX), strict=True))}) found
  WHERE kind <> 'assign' OR length(regexp_extract(found, {_sql_text(ASSIGN)}, 2)) >= {ASSIGN_CHARS}
), more AS ({" UNION ALL ".join(f"({_sql_class(c)})" for c in CLASSES)}),
every AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM more m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = m.rid AND b.start <= m.start AND b.stop >= m.stop)
), counts AS (
  SELECT rid, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)} FROM base GROUP BY rid
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE_KINDS)},
       sha256(coalesce(b.joined, '')) AS base_sha256, coalesce(e.joined, '') AS spans
FROM texts
LEFT JOIN counts USING (rid)
LEFT JOIN ({_sql_joined("base", BASE_KINDS)}) b USING (rid)
LEFT JOIN ({_sql_joined("every", _KINDS)}) e USING (rid)
"""
