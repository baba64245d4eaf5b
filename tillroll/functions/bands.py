"""Banding a numeric column into named classes.

Both helpers take the bands in the order they are tried. A null value satisfies
no comparison, so it lands in ``otherwise`` like any value past the last band.
"""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _chain(tests: list[tuple[Column, str]], otherwise: str) -> Column:
    (first, label), *rest = tests
    whens = reduce(lambda c, t: c.when(t[0], F.lit(t[1])), rest, F.when(first, F.lit(label)))
    return whens.otherwise(F.lit(otherwise))


def below(value: Column, limits: Mapping[str, float], otherwise: str) -> Column:
    """The first class whose (exclusive) upper limit lies above the value."""
    return _chain([(value < limit, label) for label, limit in limits.items()], otherwise)


def at_least(value: Column, floors: Mapping[str, float], otherwise: str) -> Column:
    """The first class whose (inclusive) lower limit the value reaches."""
    return _chain([(value >= floor, label) for label, floor in floors.items()], otherwise)


def above(value: Column, floors: Mapping[str, float], otherwise: str) -> Column:
    """The first class whose (exclusive) lower limit the value passes."""
    return _chain([(value > floor, label) for label, floor in floors.items()], otherwise)


def matching(value: Column, labels: Mapping[str, str], otherwise: str) -> Column:
    """The class of an exactly equal (case-sensitive, untrimmed) string."""
    return _chain([(value == word, label) for word, label in labels.items()], otherwise)
