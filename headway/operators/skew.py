"""Joins and windows over rows that may hold one very frequent key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SALTS = 8
_SALT = "_salt"


def _number(salts: int | Column) -> Column:
    return salts if isinstance(salts, Column) else F.lit(salts)


def with_salt(large: DataFrame, spread_by: list[str], salts: int | Column) -> DataFrame:
    """Give each row a salt from some of its values and the number of its partition.

    The partition number spreads exact copies too. Unlike a random number it is
    the same when a lost task is run again. Name few and cheap columns: they are
    evaluated for every row.
    """
    mixed = F.xxhash64(*spread_by) + F.spark_partition_id()
    return large.withColumn(_SALT, F.pmod(mixed, _number(salts)).cast("int"))


def with_every_salt(small: DataFrame, salts: int | Column) -> DataFrame:
    """Repeat each row once per salt."""
    return small.withColumn(_SALT, F.explode(F.sequence(F.lit(0), _number(salts) - 1)))


def crowded_groups(rows: DataFrame, keys: list[str], rows_per_task: int) -> DataFrame:
    """Groups of more than ``rows_per_task`` rows, with ``_salts``, the tasks each is to be shared by.

    There are at most ``rows / rows_per_task`` of them, which bounds their
    broadcast: one million entries for two trillion rows at the default.
    """
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > rows_per_task)
        .select(*keys, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))
    )


def salted_join(large: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", *,
                spread_by: list[str], salts: int = DEFAULT_SALTS) -> DataFrame:
    """Equi-join in which one key of ``large`` is shared out over ``salts`` tasks.

    Exact for inner, left, left_semi and left_anti joins: each large row has one
    salt, and that salt sees all of ``small``. ``spread_by`` names columns that
    differ between rows of one key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how}")
    if salts == 1:
        return large.join(small, keys, how)
    joined = with_salt(large, spread_by, salts).join(
        with_every_salt(small, salts), [*keys, _SALT], how
    )
    return joined.drop(_SALT)
