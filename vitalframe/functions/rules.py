"""Column builders for clinical rule tables.

A rule table is plain data: an ordered list of ``(label, test)`` pairs, where a test turns a
column into a condition.  Order matters and gaps are allowed: a value that falls between two
closed bands takes the table's default, exactly as the published rules behave.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Test = Callable[[Column], Column]


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- interval tests ---------------------------------------------------------------------------
def below(x: float) -> Test:
    return lambda c: c < x


def up_to(x: float) -> Test:
    return lambda c: c <= x


def span(lo: float, hi: float) -> Test:
    """Closed on both ends."""
    return lambda c: c.between(lo, hi)


def at_least(x: float) -> Test:
    return lambda c: c >= x


def above(x: float) -> Test:
    return lambda c: c > x


# --- category builders ------------------------------------------------------------------------
def first_match(cases: Iterable[tuple[object, Column]], default: object = None) -> Column:
    """Value of the first case whose condition holds, else ``default`` (NULL when not given)."""
    chain = None
    for value, cond in cases:
        chain = F.when(cond, value) if chain is None else chain.when(cond, value)
    if chain is None:
        raise ValueError("a rule needs at least one case")
    return chain if default is None else chain.otherwise(default)


def band(col: str | Column, table: Sequence[tuple[object, Test]], default: object = "unknown") -> Column:
    c = _c(col)
    return first_match([(label, test(c)) for label, test in table], default)


def band_half_open(col: str | Column, cuts: Sequence[float], labels: Sequence[str], default: str) -> Column:
    """``len(cuts) + 1`` labels; a value equal to a cut belongs to the band above it."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one label more than cuts")
    c = _c(col)
    cases = [(label, c < cut) for cut, label in zip(cuts, labels)]
    return first_match([*cases, (labels[-1], c >= cuts[-1])], default)


def flag(cond: Column) -> Column:
    """Two-valued: an unknown condition counts as false."""
    return F.coalesce(cond, F.lit(False))


def tri_flag(col: str | Column, yes: str, no: str) -> Column:
    """Three-valued: text outside the two known words stays NULL."""
    word = F.lower(_c(col))
    return F.when(word == yes, True).when(word == no, False)


def vocab(col: str | Column, table: Mapping[object, Sequence[str]], default: object = "unknown") -> Column:
    """Map free text to a standard label through lower-case word lists."""
    word = F.lower(_c(col))
    return first_match([(label, word.isin(list(words))) for label, words in table.items()], default)


def lookup(col: str | Column, table: Mapping[str, object], default: object = None) -> Column:
    c = _c(col)
    return first_match([(value, c == key) for key, value in table.items()], default)


def one_of(col: str | Column, *values: object) -> Column:
    return _c(col).isin(list(values))


# --- scores -----------------------------------------------------------------------------------
def points(cond: Column, n: int = 1) -> Column:
    return F.when(cond, n).otherwise(0)


def steps(col: str | Column, table: Sequence[tuple[int, Test]], default: int | None = 0) -> Column:
    """Points from the first matching step; ``default=None`` leaves an unmatched value NULL."""
    c = _c(col)
    chain = first_match([(n, test(c)) for n, test in table])
    return chain if default is None else chain.otherwise(default)


def score(*terms: Column) -> Column:
    """Sum of terms; one NULL term makes the whole score NULL."""
    return reduce(lambda a, b: a + b, terms).cast("int")


def criteria_count(conditions: Sequence[Column]) -> Column:
    return score(*[points(c) for c in conditions])


# --- text -------------------------------------------------------------------------------------
def topics(terms: Sequence[tuple[str, Column]], default: str | None = None) -> Column:
    """Comma-joined labels of the terms that hold."""
    joined = F.concat_ws(", ", *[F.when(cond, label) for label, cond in terms])
    if default is None:
        return joined
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit(default))


def flags_for(groups: Sequence[tuple[Column, Sequence[str]]]) -> dict[str, Column]:
    """Expand ``(condition, [flag names])`` groups into one boolean column per name."""
    return {name: flag(cond) for cond, names in groups for name in names}


# --- arithmetic and dates ---------------------------------------------------------------------
def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """Double ratio, NULL for a zero or NULL divisor."""
    return _c(a).cast("double") / F.nullif(_c(b).cast("double"), F.lit(0.0))


def mean_arterial(systolic: str | Column, diastolic: str | Column) -> Column:
    s, d = _c(systolic), _c(diastolic)
    return d + (s - d) / F.lit(3.0)


def years_since(ts: str | Column, as_of: dt.date) -> Column:
    return F.lit(as_of.year) - F.year(_c(ts))


def age_years(born: str | Column, as_of: dt.date) -> Column:
    """Completed years on ``as_of``."""
    b = _c(born)
    today = as_of.month * 100 + as_of.day
    not_yet = (F.month(b) * 100 + F.dayofmonth(b)) > today
    return F.lit(as_of.year) - F.year(b) - not_yet.cast("int")
