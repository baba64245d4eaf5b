"""Averages of doubles that do not depend on the order of the rows.

A sum of doubles changes in its last digits with the order in which tasks finish. Here each
value is taken apart into a whole mantissa and a power of two. Mantissas of one power add up
exactly, in any order, and the few sums of a group are added from the smallest power up.
Mantissas are summed as two halves, each a long that holds the sum of 2 ** 36 of them.
"""

from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a double's mantissa.
BITS = 53
#: Bits of the lower half of a mantissa.
LOW_BITS = 27
Aggregate = Callable[[str], Column]


def _times_power(value: Column, power: Column) -> Column:
    """value * 2 ** power. In two steps, since half a power is always a normal double."""
    half = F.floor(power / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def _guess(value: Column) -> Column:
    """Power of a finite value, off by one at most; null for zero."""
    return F.floor(F.log2(F.nullif(F.abs(value), F.lit(0.0)))) - (BITS - 1)


def _whole_and_power(value: Column, scaled: Column, guess: Column) -> tuple[Column, Column]:
    """Mantissa and power from the value divided by its guessed power of two."""
    size = F.abs(scaled)
    large, small = size >= 2.0**BITS, size < 2.0 ** (BITS - 1)
    mantissa = F.when(large, scaled * 0.5).when(small, scaled * 2.0).otherwise(scaled)
    moved = F.when(large, 1).when(small, -1).otherwise(0)
    zero, finite = value == 0, _finite(value)
    return (
        F.when(finite, F.when(zero, 0).otherwise(mantissa.cast("bigint"))),
        F.when(finite, F.when(zero, 0).otherwise((guess + moved).cast("int"))),
    )


def mantissa_and_power(value: Column) -> tuple[Column, Column]:
    """A finite value as mantissa * 2 ** power, the mantissa whole and of 53 bits.

    Both null for null, NaN and infinities; zero has a power of zero. The logarithm can be
    off by one next to a power of two, so the mantissa it gives is moved into its range.
    """
    guess = _guess(value)
    return _whole_and_power(value, _times_power(value, -guess), guess)


def with_mantissa_and_power(rows: DataFrame, value: str) -> DataFrame:
    """Columns ``_mantissa`` and ``_power`` of a value, and it as double in ``_value``.

    Each step is a column: as one expression the logarithm and the powers would be worked
    out again wherever they are used, dozens of times a row.
    """
    number, guess, scaled = F.col("_value"), F.col("_guess"), F.col("_scaled")
    steps = (
        rows.withColumn("_value", F.col(value).cast("double"))
        .withColumn("_guess", _guess(number))
        .withColumn("_scaled", _times_power(number, -guess))
    )
    mantissa, power = _whole_and_power(number, scaled, guess)
    found = steps.withColumns({"_mantissa": mantissa, "_power": power})
    return found.drop("_guess", "_scaled")


def averages(
    rows: DataFrame,
    by: list[str],
    value: str,
    name: str,
    others: Mapping[str, tuple[Callable, Callable, str]],
) -> DataFrame:
    """Average of ``value`` for each group, as column ``name``, and other aggregates.

    Nulls do not count; NaN and infinities give what ``avg`` gives. ``others`` maps a column
    to (aggregate, aggregate of its partial results, input column). Rows are combined before
    the shuffle by group and power of two, of which a double has some two thousand and a
    column of amounts a few dozen.
    """
    mantissa = F.col("_mantissa")
    low = F.lit((1 << LOW_BITS) - 1).cast("bigint")
    parts = (
        with_mantissa_and_power(rows, value)
        .withColumns(
            {
                "_mantissa_high": F.shiftright(mantissa, LOW_BITS),
                "_mantissa_low": mantissa.bitwiseAND(low),
                "_special": F.when(mantissa.isNull(), F.col("_value")),
            }
        )
        .groupBy(*by, "_power")
        .agg(
            F.sum("_mantissa_high").alias("_high"),
            F.sum("_mantissa_low").alias("_low"),
            F.sum("_special").alias("_special"),
            F.count(value).alias("_n"),
            *(first(column).alias(other) for other, (first, _, column) in others.items()),
        )
    )
    sum_ = F.col("_high").cast("decimal(20,0)") * F.lit(Decimal(1 << LOW_BITS)) + F.col("_low")
    part = F.struct("_power", sum_.cast("double").alias("_sum"))
    summed = parts.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.when(F.col("_power").isNotNull(), part))).alias("_parts"),
        F.sum("_special").alias("_special"),
        F.sum("_n").alias("_n"),
        *(second(other).alias(other) for other, (_, second, _) in others.items()),
    )
    total = F.aggregate(
        "_parts", F.lit(0.0), lambda sum_, p: sum_ + _times_power(p["_sum"], p["_power"])
    )
    # Any value that is not finite decides the sum by itself.
    average = F.try_divide(F.coalesce("_special", total), F.col("_n"))
    return summed.select(*by, average.alias(name), *others)
