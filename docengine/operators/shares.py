"""Work asked of one row, dealt out by how often the row is asked."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Different values asked of a row that one task answers in one go.
SHARE = 1000


def with_lists(
    asked: DataFrame, rows: DataFrame, key: str, value: str, size: int = SHARE
) -> DataFrame:
    """`rows`, unique by `key`, with `asked`, a list of the values asked of each.

    `asked(key, value)` holds different pairs.  Their number per key decides: a key asked
    for n values has ceil(n / size) rows, each with about `size` of them, which are dealt to
    tasks by key and share; all others have one row.  The rows meet the first lists and the
    further ones, which few keys have, by the same exchange, so that a row is moved once and
    again only with each further list.
    """
    asked = asked.filter(F.col(key).isNotNull())
    often = (
        asked.groupBy(key)
        .agg(F.ceil(F.count("*") / size).alias("_shares"))
        .filter(F.col("_shares") > 1)
    )
    shares = F.coalesce("_shares", F.lit(1))
    lists = (
        asked.join(often, key, "left")
        .withColumn("_share", F.pmod(F.xxhash64(value), shares))
        .groupBy(key, "_share")
        .agg(F.collect_list(value).alias("asked"))
    )
    first = rows.join(lists.filter(F.col("_share") == 0), key)
    further = rows.join(lists.filter(F.col("_share") > 0), key).repartition(key, "_share")
    return first.unionByName(further).drop("_share")
