"""Keeping one busy key from landing in one task.

Every time-ordered operator groups by some key (a user, a session, an address). A service account can own
a third of all rows, so a plain ``partitionBy(key)`` would sort that third in one task. Here a key with more
than ``max_rows`` rows is cut along time into *slots*, windows run per (key, slot), and the few rows a slot
needs from its neighbours are copied in as *carry* rows. All other keys stay whole in slot 0 and pay
nothing beyond a count per key.

The table of hot keys has at most ``rows / max_rows`` rows (200,000 for 10^12 events at the default), which
is the bound that makes broadcasting it safe at any input size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.schema import MINUTE_US

HOT_ROWS = 5_000_000


def micros(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(column.cast("timestamp"))


def hot_keys(
    df: DataFrame,
    keys: list[str],
    time: str | Column | None = None,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per key with more than ``max_rows`` rows: its salt count and, given a time, its slot width.

    Keys are counted first, which shuffles one row per key and task; only the rows of heavy keys, often none, are
    then counted per minute. The slot width follows the densest minute, so a burst is cut as finely as it needs.
    """
    heavy = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows)
    if time is None:
        width = F.lit(None).cast("bigint")
    else:
        rows = df.join(F.broadcast(heavy.select(*keys)), keys, "left_semi")
        per_minute = rows.groupBy(*keys, F.floor(micros(time) / MINUTE_US).alias("_minute")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        heavy = per_minute.groupBy(*keys).agg(
            F.sum("_n").alias("_n"),
            F.max("_n").alias("_peak"),
            F.min("_minute").alias("_first"),
            F.max("_minute").alias("_last"),
        )
        # in doubles: a month in microseconds times millions of rows is beyond 64 bits
        room = F.lit(float(MINUTE_US)) * F.lit(float(max_rows))
        even = (F.col("_last") - F.col("_first") + 1) * room / F.col("_n")
        burst = room / F.col("_peak")
        width = F.greatest(F.least(F.ceil(even), F.ceil(burst)), F.lit(1)).cast("bigint")
    return heavy.select(*keys, F.ceil(F.col("_n") / max_rows).cast("int").alias("_salts"), width.alias("_slot_us"))


#: Busy keys already looked for, by table and keys.
_FOUND: dict[tuple, list[tuple[DataFrame, DataFrame | None]]] = {}


def busy_keys(
    df: DataFrame, keys: list[str], time: str | Column | None = None, max_rows: int = HOT_ROWS
) -> DataFrame | None:
    """``hot_keys``, looked for once per table and written; None where no key is busy, so plans need no slots or salts.

    Plans over the same table ask for the same keys again and again; they share the answer. It only picks the plan: an
    answer from before rows were added gives the same results. Streams can't be counted first and get the open plan.
    """
    if df.isStreaming:
        return hot_keys(df, keys, time, max_rows)
    place = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), tuple(keys), str(time), max_rows)
    known = _FOUND.setdefault(place, [])
    for table, hot in known:
        if table.sameSemantics(df):
            return hot
    hot = hot_keys(df, keys, time, max_rows)
    # at most rows / max_rows rows, mostly none
    rows = hot.collect()
    found = df.sparkSession.createDataFrame(rows, hot.schema) if rows else None
    known.append((df, found))
    return found


def add_slots(df: DataFrame, keys: list[str], hot: DataFrame, us: str = "_us") -> DataFrame:
    """Add ``_slot``: the time slice of a hot key, 0 for every other key."""
    widths = F.broadcast(hot.select(*keys, "_slot_us"))
    return (
        df.join(widths, keys, "left")
        .withColumn(
            "_slot",
            F.when(F.col("_slot_us").isNull(), F.lit(0).cast("bigint")).otherwise(
                F.floor(F.col(us) / F.col("_slot_us"))
            ),
        )
        .drop("_slot_us")
    )


def only_hot(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    return df.join(F.broadcast(hot.select(*keys)), keys, "left_semi")


class Timeline:
    """Rows of each key in time order, cut into slots, with ``back`` / ``ahead`` neighbour rows carried in.

    ``rows`` holds the given columns plus ``_us`` and ``_carry``; ``window()`` is the ordered window to use;
    ``finish(df)`` drops the carried copies and helper columns again.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        tie: list[str],
        time: str = "timestamp",
        back: int = 0,
        ahead: int = 0,
        max_rows: int = HOT_ROWS,
    ):
        self.keys, self.tie = keys, tie
        timed = df.withColumn("_us", micros(time))
        hot = busy_keys(df, keys, time, max_rows)
        if hot is None:
            self.rows = timed.withColumns({"_slot": F.lit(0).cast("bigint"), "_carry": F.lit(False)})
            return
        slotted = add_slots(timed, keys, hot)
        parts = [slotted.withColumn("_carry", F.lit(False))]
        hot_rows = add_slots(only_hot(timed, keys, hot), keys, hot)
        if back:
            parts.append(self._neighbours(hot_rows, back, last=True))
        if ahead:
            parts.append(self._neighbours(hot_rows, ahead, last=False))
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        self.rows = rows

    def _neighbours(self, rows: DataFrame, k: int, last: bool) -> DataFrame:
        columns = rows.columns
        by = [F.col("_us"), *(F.col(t) for t in self.tie)]
        edge = Window.partitionBy(*self.keys, "_slot").orderBy(*[c.desc() if last else c.asc() for c in by])
        # at most k rows per slot survive, on the map side as well
        edges = (
            rows.withColumn("_rank", F.row_number().over(edge))
            .where(F.col("_rank") <= k)
            .groupBy(*self.keys, "_slot")
            .agg(F.collect_list(F.struct(*[c for c in columns if c not in (*self.keys, "_slot")])).alias("_rows"))
        )
        # every slot listed here holds at least one row, so k slots hold the k rows needed
        slots = Window.partitionBy(*self.keys).orderBy("_slot")
        frame = slots.rowsBetween(-k, -1) if last else slots.rowsBetween(1, k)
        carried = edges.withColumn("_near", F.flatten(F.collect_list("_rows").over(frame))).select(
            *self.keys, "_slot", F.explode("_near").alias("_row")
        )
        return carried.select(*self.keys, "_slot", "_row.*").select(*columns, F.lit(True).alias("_carry"))

    def partition(self, *more: str):
        return Window.partitionBy(*self.keys, "_slot", *more)

    def window(self):
        return self.partition().orderBy("_us", *self.tie)

    def finish(self, df: DataFrame) -> DataFrame:
        return df.where(~F.col("_carry")).drop("_carry", "_slot", "_us")


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    base: DataFrame | None = None,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join a big table with a table of few rows per key; rows of a hot key are spread over several tasks.

    Only the hot keys' rows of ``small`` are repeated. ``spread`` names columns of ``big`` whose hash picks
    the salt (a row identity). ``base`` is the table to count keys in, when ``big`` is the outcome of a long plan:
    its rows are a subset or equal in number per key, and counting the source does not run that plan twice.
    """
    hot = busy_keys(big if base is None else base, keys, None, max_rows)
    if hot is None and how in ("inner", "left", "left_semi", "left_anti"):
        return big.join(small, keys, how)
    if hot is None:
        hot = hot_keys(big if base is None else base, keys, None, max_rows)
    salts = F.broadcast(hot.select(*keys, "_salts"))
    spread = spread or [c for c in big.columns if c not in keys]
    # rows with a missing key match nothing, so an outer join may scatter them freely
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    left = (
        big.join(salts, keys, "left")
        .withColumn(
            "_salt",
            F.when(missing, F.xxhash64(*spread))
            .when(F.col("_salts").isNull(), F.lit(0).cast("bigint"))
            .otherwise(F.pmod(F.xxhash64(*spread), F.col("_salts").cast("bigint"))),
        )
        .drop("_salts")
    )
    right = (
        small.join(salts, keys, "left")
        .withColumn("_salts", F.coalesce("_salts", F.lit(1)).cast("bigint") - 1)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts"))))
        .drop("_salts")
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    name: str,
    slot: Column,
) -> DataFrame:
    """Inclusive running total of ``value`` in the given order within few, large groups.

    ``slot`` cuts the order into stretches; each is summed on its own, and prefix sums over the stretches supply the
    starting offset, so no task ever orders a whole group.
    """
    slotted = df.withColumn("_slot", slot).withColumn("_v", value)
    sums = slotted.groupBy(*keys, "_slot").agg(F.sum("_v").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_slot", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    local = Window.partitionBy(*keys, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        slotted.join(offsets, [*keys, "_slot"])
        .withColumn(name, F.col("_offset") + F.sum("_v").over(local))
        .drop("_slot", "_v", "_offset")
    )
