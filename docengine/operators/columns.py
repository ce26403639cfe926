"""Helpers for columns that may be absent."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_or(df: DataFrame, name: str, default: Column) -> Column:
    """The column when the frame has it, else the default."""
    return F.col(f"`{name}`") if name in df.columns else default


def true_or_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def fill_text(df: DataFrame) -> DataFrame:
    """Nulls of text columns to empty text."""
    return df.na.fill("")


def unfold(df: DataFrame, keep: list, items: Column, by: str) -> DataFrame:
    """A row per struct in `items`; rows whose field `by` is null are left out.

    A plain explode makes the optimizer derive a filter on the list and push it down,
    where the list is computed again; here it is computed once.
    """
    return df.select(*keep, F.inline_outer(items)).filter(F.col(by).isNotNull())


def salted_left_join(
    left: DataFrame, right: DataFrame, by: Column, key: str, row_key: str, salts: int
) -> DataFrame:
    """Left join of `by` to the unique column `key` of a narrow table, hot keys split.

    Rows of one key go to `salts` tasks, by their row key, so that a repeated task deals
    them out alike; `right` is copied once per salt.  With 1, nothing is copied and hot
    keys are left to adaptive skew splitting.  `key` is dropped.
    """
    if salts == 1:
        return left.join(right, by == F.col(key), "left").drop(key)
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(row_key), F.lit(salts)))
    copies = right.withColumn(
        "_copy", F.explode(F.array(*[F.lit(i).cast("long") for i in range(salts)]))
    )
    same = (by == F.col(key)) & (F.col("_salt") == F.col("_copy"))
    return spread.join(copies, same, "left").drop(key, "_salt", "_copy")


def ragged_union(*frames: DataFrame) -> DataFrame:
    """Append frames with different columns; what a frame lacks is null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
