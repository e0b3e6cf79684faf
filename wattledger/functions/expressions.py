"""Column expressions shared by the operators. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reading states, invoice line kinds, exception names, control colours and variance causes.
ON_TIME, LATE, ESTIMATED = "on_time", "late", "estimated"
RECURRING, OVERAGE, CREDIT = "recurring", "overage", "credit"
LATE_DATA, ESTIMATED_USAGE, COST_TRUE_UP, NO_FLAG = (
    "Late Meter Data",
    "Estimated Usage",
    "Power Cost True-Up",
    "No Flag",
)
GREEN, YELLOW, RED = "Green", "Yellow", "Red"
CAUSE_MAPPING, CAUSE_MISSING, CAUSE_TIMING, CAUSE_LATE, CAUSE_NONE = (
    "mapping",
    "missing data",
    "timing",
    "late data",
    "none",
)

# Documented tolerance in percent and backfill window in days.
GREEN_MAX_PCT = 1.0
BACKFILL_DAYS = 7
# Ours: the colours are documented, the cut between yellow and red is not.
YELLOW_MAX_PCT = 5.0


def month_floor(day: Column) -> Column:
    return F.trunc(day, "month")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def day_sequence(first: Column, last: Column) -> Column:
    """Every date from first to last, both included; empty when last lies before first."""
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>")
    )


def month_sequence(first: Column, last: Column) -> Column:
    """First-of-month dates of every month that overlaps [first, last]."""
    start = month_floor(first)
    return F.when(first <= last, F.sequence(start, last, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>")
    )


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def count_where(condition: Column) -> Column:
    return F.sum(flag(condition))


def cents(amount: Column) -> Column:
    """A two-decimal amount as a whole number of cents."""
    return (amount * 100).cast("bigint")


def sum_cents(amount_in_cents: Column, declared: str) -> Column:
    """Exact sum of cents as the declared decimal.

    Integer sums stay in fixed-width buffers, where decimal sums of this width build an object per row.
    Room for 9e16 units is far beyond what the declared types of a contract-month hold.
    """
    return (F.sum(amount_in_cents).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(declared)


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of the value over matching rows, 0 when none match."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; NULL for a zero denominator instead of an ANSI division error."""
    bottom = denominator.cast("double")
    return F.when(bottom != 0, numerator.cast("double") / bottom)


def clamp(value: Column, low: Column, high: Column) -> Column:
    """The value inside its limits; NULL stays NULL, which ``greatest`` alone would turn into a limit."""
    return F.when(value.isNotNull(), F.greatest(low, F.least(high, value)))


def customer_label(customer_id: Column) -> Column:
    """Display name with the id padded to two digits."""
    return F.format_string("Customer_%02d", customer_id)


def surrogate_key(source: Column, *parts: Column) -> Column:
    """128-bit key over the source system and the parts in order, stable between runs and partitionings.

    Every part is preceded by its length, a NULL is marked as such: parts that differ in any way never
    make the same text, whatever they hold. A 64-bit hash would be shorter, but with a billion keys it collides with a chance of some per cent,
    and two contracts merged by a collision would be silent.
    """
    texts = [p.cast("string") for p in (source, *parts)]
    marked = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("null")) for t in texts]
    return F.md5(F.concat_ws(";", *marked).cast("binary"))


def exception_reason(late_days: Column, estimated_days: Column, true_up: Column) -> Column:
    """First reason that applies, in order of severity."""
    return (
        F.when(late_days > 0, LATE_DATA)
        .when(estimated_days > 0, ESTIMATED_USAGE)
        .when(true_up, COST_TRUE_UP)
        .otherwise(NO_FLAG)
    )


def variance_pct(expected: Column, actual: Column) -> Column:
    """Unrounded 100 * (actual - expected) / expected; NULL when nothing was expected."""
    return 100 * ratio(actual - expected, expected)


def control_status(
    expected: Column,
    actual: Column,
    green_max_pct: float = GREEN_MAX_PCT,
    yellow_max_pct: float = YELLOW_MAX_PCT,
) -> Column:
    """Green inside the tolerance, Yellow up to the second limit, Red beyond it.

    With nothing expected the percentage is undefined: Green if nothing came either, else Red.
    """
    size = F.abs(variance_pct(expected, actual))
    return (
        F.when((expected == 0) & (actual == 0), GREEN)
        .when(size.isNull(), RED)
        .when(size <= green_max_pct, GREEN)
        .when(size <= yellow_max_pct, YELLOW)
        .otherwise(RED)
    )


def lateness(reading_date: Column, ingested_at: Column, backfill_days: int = BACKFILL_DAYS) -> Column:
    """on_time on the day itself, late inside the backfill window, estimated after it or when missing."""
    lag = F.datediff(ingested_at.cast("date"), reading_date)
    return (
        F.when(ingested_at.isNull(), ESTIMATED)
        .when(lag <= 0, ON_TIME)
        .when(lag <= backfill_days, LATE)
        .otherwise(ESTIMATED)
    )


def key_text(columns: Sequence[str]) -> Column:
    """Key values as one readable string, NULL parts shown as such."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])
