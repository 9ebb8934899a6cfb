"""Additive roll-ups.

Every number the aggregate tables show is derived from *facts* that can be added up:
a sum, a count, a maximum.  An average is kept as its sum and its count, and a distinct
count as the distinct values themselves (they are part of the finer grain).  So the same
three steps produce a table from raw rows, from a stored roll-up, or from a stored
roll-up plus the roll-up of newly arrived rows, always with the same result:

    lift      one row -> its facts
    regroup   facts -> facts at a coarser grain
    measures  facts -> the numbers shown
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Fact:
    """``of_row`` gives the value for one source row, ``merge`` the aggregate that adds up."""

    name: str
    of_row: Callable[[], Column]
    merge: Callable[[Column], Column] = F.sum


def tally(name: str, condition: Callable[[], Column]) -> Fact:
    return Fact(name, lambda: condition().cast("int"))


#: Sums are kept as whole numbers of this part of a unit, so that they do not depend on the order of
#: addition: a stored roll-up and a full build agree to the last bit.
PARTS_OF_UNIT = 10_000
#: Parts of one value; a sum has ten digits more.
_PARTS = "decimal(28,0)"


def _in_parts(value: Column) -> Column:
    """A measure in whole parts; null stays null.  What is no number, infinite or beyond 10**24 units
    fails the job: leaving it out would change sums and means unseen."""
    parts = F.round(value * PARTS_OF_UNIT).try_cast(_PARTS)
    text = F.concat(F.lit("a measure cannot be added up: "), value.cast("string"))
    return F.when(value.isNotNull(), F.coalesce(parts, F.raise_error(text).cast(_PARTS)))


def mean_parts(name: str, value: Callable[[], Column]) -> tuple[Fact, Fact]:
    """The exact sum of a measure, four decimals of it, and how many rows have one."""
    return (
        Fact(f"{name}_sum", lambda: _in_parts(value())),
        tally(f"{name}_n", lambda: value().isNotNull()),
    )


def in_units(parts: Column | str) -> Column:
    """A sum of parts as a plain figure."""
    return (F.col(parts) if isinstance(parts, str) else parts).cast("double") / PARTS_OF_UNIT


def lift(rows: DataFrame, facts: Iterable[Fact], dimensions: Sequence[str]) -> DataFrame:
    """Source rows as a roll-up of the finest grain; unused columns are pruned later on."""
    return rows.select(*dimensions, *[fact.of_row().alias(fact.name) for fact in facts])


def regroup(
    parts: DataFrame, grain: Sequence[str], facts: Iterable[Fact], *more: Column
) -> DataFrame:
    """Adds facts up to ``grain``.  Summed on the map side first, so what is shuffled is one
    row per key and task however many rows a key has."""
    return parts.groupBy(*grain).agg(
        *[fact.merge(F.col(fact.name)).alias(fact.name) for fact in facts], *more
    )


def merge_parts(
    stored: DataFrame, delta: DataFrame, grain: Sequence[str], facts: Iterable[Fact]
) -> DataFrame:
    """The roll-up of old and new rows together, without touching the old rows again."""
    return regroup(stored.unionByName(delta), grain, facts)


@dataclass(frozen=True)
class Measure:
    """A shown number, computed from merged facts."""

    name: str
    value: Callable[[], Column]
    uses: tuple[str, ...]

    def column(self) -> Column:
        return self.value().alias(self.name)


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def count_of(name: str, fact: str) -> Measure:
    return Measure(name, lambda: F.col(fact), (fact,))


def total_of(name: str, fact: str, digits: int | None = 2, empty: float | None = None) -> Measure:
    """A sum; ``empty`` is shown where nothing was added up."""

    def value() -> Column:
        summed = in_units(fact)
        return _rounded(summed if empty is None else F.coalesce(summed, F.lit(empty)), digits)

    return Measure(name, value, (fact,))


def mean_of(name: str, fact: str, digits: int) -> Measure:
    """Sum over count; null where the count is zero."""
    parts = (f"{fact}_sum", f"{fact}_n")

    def value() -> Column:
        whole = F.col(parts[0]).cast("double")
        return _rounded(F.try_divide(whole, F.col(parts[1]) * PARTS_OF_UNIT), digits)

    return Measure(name, value, parts)


def percent_of(name: str, part: str, whole: str, digits: int = 1) -> Measure:
    return Measure(
        name,
        lambda: _rounded(F.try_divide(F.col(part) * 100.0, F.col(whole)), digits),
        (part, whole),
    )


def latest_of(name: str, fact: str) -> Measure:
    return Measure(name, lambda: F.col(fact), (fact,))
