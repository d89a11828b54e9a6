"""For each row, the time of the next target row of the same key, strictly later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.skew import HOT_ROWS, add_slots, busy_keys, micros, only_hot


def next_target(
    df: DataFrame,
    keys: list[str],
    is_target: Column,
    time: str = "timestamp",
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """``df`` plus ``_us`` and ``_next_us``.

    Runs as one pass in descending time, where "strictly later" is a frame that only grows; an unbounded following
    frame would be quadratic. A hot key's slot takes over the earliest target of all later slots.
    """
    rows = df.withColumn("_us", micros(time)).withColumn("_target", is_target)
    hot = busy_keys(df, keys, time, max_rows)
    target_us = F.when(F.col("_target"), F.col("_us"))
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(-F.col("_us")).rangeBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("_next_us", F.min(target_us).over(w)).drop("_target")
    heads = (
        add_slots(only_hot(rows, keys, hot), keys, hot).groupBy(*keys, "_slot").agg(F.min(target_us).alias("_head"))
    )
    later = Window.partitionBy(*keys).orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        heads.withColumn("_us", F.min("_head").over(later))
        .where(F.col("_us").isNotNull())
        .select(*keys, "_slot", "_us", F.lit(True).alias("_target"), F.lit(True).alias("_carry"))
    )
    slotted = add_slots(rows, keys, hot).withColumn("_carry", F.lit(False))
    w = Window.partitionBy(*keys, "_slot").orderBy(-F.col("_us")).rangeBetween(Window.unboundedPreceding, -1)
    return (
        slotted.unionByName(carry, allowMissingColumns=True)
        .withColumn("_next_us", F.min(target_us).over(w))
        .where(~F.col("_carry"))
        .drop("_slot", "_carry", "_target")
    )
