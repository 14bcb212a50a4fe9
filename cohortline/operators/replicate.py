"""Expanding counted rows and splitting hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replicate(df: DataFrame, times: str, ordinal: str = "ordinal", chunk: int = 10_000) -> DataFrame:
    """Each row repeated ``times`` times with an ordinal from 0. A large count is
    first cut into chunk rows that spread over the tasks, so no task and no
    array ever holds more than ``chunk`` copies of one row."""
    blocks = (
        df.filter(F.col(times) > 0)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(times) - 1) / F.lit(chunk)))))
        .repartition(max(8, df.sparkSession.sparkContext.defaultParallelism))
    )
    first = F.col("_block") * chunk
    last = F.least(F.col(times).cast("bigint") - 1, first + chunk - 1)
    return blocks.withColumn(ordinal, F.explode(F.sequence(first, last))).drop("_block")


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Inner join to a lookup that is unique per key. ``hot`` lists the keys that
    hold more than a thousandth of all rows, hence fewer than a thousand: they
    join by broadcast, every other key by shuffle."""
    keys = list(keys)
    marked = F.broadcast(hot.select(*keys).withColumn("_hot", F.lit(True)))
    flagged_rows = rows.join(marked, keys, "left")
    flagged_lookup = lookup.join(marked, keys, "left")
    hot_part = flagged_rows.filter("_hot").drop("_hot").join(F.broadcast(flagged_lookup.filter("_hot").drop("_hot")), keys)
    cold_part = flagged_rows.filter("_hot IS NULL").drop("_hot").join(flagged_lookup.filter("_hot IS NULL").drop("_hot"), keys)
    return hot_part.unionByName(cold_part)
