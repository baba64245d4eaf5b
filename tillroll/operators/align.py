"""Fitting an arbitrary input to the declared order schema."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StringType

from tillroll.functions.names import clean_names
from tillroll.schema import ALIGNED_COLUMNS


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename every column at once, by position, so clashing headers stay apart."""
    return df.toDF(*clean_names(df.columns))


def _fit(df: DataFrame, name: str, target: DataType) -> Column:
    """The column as ``target``: null if it is missing or a cell does not convert."""
    if name not in df.columns:
        return F.lit(None).cast(target).alias(name)
    value = F.col(name)
    if isinstance(df.schema[name].dataType, StringType) and isinstance(target, IntegerType):
        # "4.7" in an integer column counts as 4, as in a non-ANSI cast.
        value = F.regexp_replace(value, r"^(\s*[+-]?\d+)\.\d*(\s*)$", "$1$2")
    return value.try_cast(target).alias(name)


def align_orders(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the aligned columns, in order and typed; anything else is dropped.

    Columns to ``keep`` follow them as they are.
    """
    cleaned = clean_columns(df)
    kept = (F.col(cleaned.columns[df.columns.index(name)]).alias(name) for name in keep)
    return cleaned.select(*(_fit(cleaned, n, t) for n, t in ALIGNED_COLUMNS.items()), *kept)
