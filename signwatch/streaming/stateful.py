"""Operators that keep state per key on a stream: user baselines, session lengths.

They need the RocksDB state store:
``spark.sql.streaming.stateStore.providerClass =
org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ListState, StatefulProcessor, StatefulProcessorHandle

from signwatch.schema import HOUR_US, MINUTE_US
from signwatch.skew import micros

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = list(rows)
    return pd.concat(parts).sort_values(["us", "event_id"]) if parts else pd.DataFrame(columns=["us", "event_id"])


#: A login, or a time at which open logins end. Event ids may be missing, and are 64-bit hashes that a float would not hold.
LOGIN = {"username": pa.string(), "us": pa.int64(), "event_id": pa.int64(), "no_id": pa.bool_()}
ROW = LOGIN | {"logout": pa.bool_()}

#: Rows that one value of a list state holds.
PART_ROWS = 100_000


def appended(state: ListState, rows: pd.DataFrame, columns: dict[str, pa.DataType]) -> None:
    """Add rows of many users to a list state, as Arrow tables: a call to the store and a value for a whole part."""
    for at in range(0, len(rows), PART_ROWS):
        part = rows.iloc[at : at + PART_ROWS]
        table = pa.table({name: pa.array(part[name], kind) for name, kind in columns.items()})
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema) as writer:
            writer.write_table(table)
        state.appendValue((out.getvalue().to_pybytes(),))


def kept(state: ListState, columns: dict[str, pa.DataType]) -> pd.DataFrame:
    """The rows of a list state."""
    tables = [pa.ipc.open_stream(pa.py_buffer(part)).read_all() for (part,) in state.get()]
    return pa.concat_tables([pa.schema(columns).empty_table(), *tables]).to_pandas()


def next_logouts(logins: pd.DataFrame, logouts: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each login whether its user has a later logout, and the time of the first one."""
    users = pd.factorize(pd.concat([logins["username"], logouts["username"]]))[0].astype("int64")
    user, of = users[: len(logins)], users[len(logins) :]
    ends = logouts["us"].to_numpy("int64")
    order = np.lexsort((ends, of))
    of, ends = of[order], ends[order]
    times = np.unique(ends)
    # a number for each user and time, in their order; a login asks for the first time after its own
    number = of * (len(times) + 1) + np.searchsorted(times, ends)
    asked = user * (len(times) + 1) + np.searchsorted(times, logins["us"].to_numpy("int64"), side="right")
    k = np.searchsorted(number, asked)
    found = k < len(number)
    k = np.where(found, k, 0)
    if not len(number):
        return found, np.zeros(len(logins), "int64")
    return found & (of[k] == user), ends[k]


class SlotPairs(StatefulProcessor):
    """Logins and logouts of a shard's users in one slot of event time, kept until the watermark has passed the slot's end.

    Then nothing earlier can come any more: logins with a logout after them in the slot are done. The logins that are left
    and each user's first logout in the slot go on, to be paired with later and earlier slots.
    """

    def __init__(self, slot_us: int):
        self.slot_us = slot_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "part binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            appended(self.rows, part, ROW)
        self.handle.registerTimer(self.end_ms(key))
        return iter(())

    def end_ms(self, key) -> int:
        return (int(key[1]) + 1) * self.slot_us // 1000

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = kept(self.rows, ROW)
        self.rows.clear()
        logouts, logins = rows[rows["logout"]], rows[~rows["logout"]]
        found, ends = next_logouts(logins, logouts)
        logins = logins.assign(end_us=ends, kind=np.where(found, DONE, WAITING))
        heads = logouts.groupby("username", sort=False, as_index=False)["us"].min()
        heads = heads.assign(event_id=0, no_id=True, end_us=0, kind=HEAD)
        out = pd.concat([logins[PAIR_COLUMNS], heads[PAIR_COLUMNS]])
        out.insert(0, "shard", int(key[0]))
        out["closed_at"] = pd.Timestamp(self.end_ms(key), unit="ms")
        yield out

    def close(self) -> None:
        pass


#: Rows of a closed slot: a login and its logout, a login without one, the first logout of a user.
DONE, WAITING, HEAD = 0, 1, 2
PAIR_COLUMNS = ["username", "us", "event_id", "no_id", "end_us", "kind"]
PAIR_SCHEMA = "shard bigint, username string, us bigint, event_id bigint, no_id boolean, end_us bigint, kind bigint, closed_at timestamp"


class Sessions(StatefulProcessor):
    """Open logins of a shard's users, kept until the first logout of a later slot closes all of a user, or until they are too old.

    Slots come closed and complete, so the rows of a batch continue those of the batches before.
    """

    def __init__(self, longest_us: int):
        self.longest_us = longest_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "part binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts, ends = [], []
        for part in rows:
            done = part[part["kind"] == DONE]
            yield self.told(done, done["end_us"])
            parts.append(part.loc[part["kind"] == WAITING, list(LOGIN)])
            ends.append(part.loc[part["kind"] == HEAD, ["username", "us"]])
        waiting, ends = pd.concat(parts), pd.concat(ends)
        if len(ends):
            waiting = pd.concat([kept(self.open, LOGIN), waiting])
            self.open.clear()
            found, logouts = next_logouts(waiting, ends)
            yield self.told(waiting[found], logouts[found])
            waiting = waiting[~found]
        if len(waiting):
            appended(self.open, waiting, LOGIN)
            self.handle.registerTimer(self.late_ms(int(waiting["us"].min())))

    def late_ms(self, us):
        return (us + self.longest_us) // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs()
        waiting = kept(self.open, LOGIN)
        late = self.late_ms(waiting["us"]) <= limit
        self.open.clear()
        if not late.all():
            appended(self.open, waiting[~late], LOGIN)
            self.handle.registerTimer(self.late_ms(int(waiting.loc[~late, "us"].min())))
        yield self.told(waiting[late], None)

    @staticmethod
    def told(logins: pd.DataFrame, ends: pd.Series | np.ndarray | None) -> pd.DataFrame:
        hours = np.nan if ends is None else (np.asarray(ends, "int64") - logins["us"].to_numpy("int64")) / HOUR_US
        ids = pd.array(logins["event_id"].to_numpy("int64"), dtype="Int64")
        ids[logins["no_id"].to_numpy(bool)] = pd.NA
        out = pd.DataFrame({"username": logins["username"].to_numpy(object), "event_id": ids})
        return out.assign(session_hours=hours).astype({"session_hours": "float64"})

    def close(self) -> None:
        pass


def session_durations(
    stream: DataFrame, delay: str = "1 hour", slot_minutes: int = 60, longest_hours: float = 24 * 90, shards: int = 256
) -> DataFrame:
    """(username, event_id, session_hours): logins with the time to the user's next logout, whatever order they arrive in.

    A row may come up to ``delay`` later than the newest login or logout of any user. A session is told when the watermark has passed the slot of event
    time its logout lies in; slots of ``slot_minutes`` are states of their own, so a busy user is many states.
    A login without a logout for ``longest_hours`` is told with null hours, and forgotten; ``start_sessions`` writes it
    to a table of its own. Rows later than the delay are dropped.

    Users are dealt out by hash to ``shards``; a state holds the users of one, so calls and timers do not grow with the number of
    users. The number stays the same for a checkpoint; at least as many as the tasks that shall run at once.
    """
    rows = stream.where(F.col("username").isNotNull() & F.col("event_type").isin("successful_login", "logout"))
    rows = rows.withWatermark("timestamp", delay)
    us = micros("timestamp")
    rows = rows.select(
        F.pmod(F.xxhash64("username"), F.lit(shards)).alias("shard"),
        F.floor(us / (slot_minutes * MINUTE_US)).alias("slot"),
        "timestamp",
        "username",
        us.alias("us"),
        F.coalesce("event_id", F.lit(0)).cast("bigint").alias("event_id"),
        F.col("event_id").isNull().alias("no_id"),
        (F.col("event_type") == "logout").alias("logout"),
    )
    slots = rows.groupBy("shard", "slot").transformWithStateInPandas(
        SlotPairs(slot_minutes * MINUTE_US), PAIR_SCHEMA, "Append", "EventTime", eventTimeColumnName="closed_at"
    )
    return slots.groupBy("shard").transformWithStateInPandas(
        Sessions(int(longest_hours * HOUR_US)), "username string, event_id bigint, session_hours double", "Append", "EventTime"
    )


def start_sessions(sessions: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Write sessions to ``sessions`` and logins that found no logout in time to ``unpaired``, a folder per micro-batch.

    A batch repeated after a failure replaces its own files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for name, part in (("sessions", batch.where("session_hours IS NOT NULL")), ("unpaired", batch.where("session_hours IS NULL"))):
            part.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        batch.unpersist()

    writer = sessions.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


class FirstEvents(StatefulProcessor):
    """The first ``first`` events of a user, then one row of habits; later events are ignored."""

    def __init__(self, first: int):
        self.first = first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "hour bigint, ip_address string")
        self.done = handle.getValueState("done", "done boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = ["username", "n", "common_ips", "preferred_times"]
        if self.done.exists():
            yield pd.DataFrame(columns=columns)
            return
        new = [(int(h), ip) for h, ip in in_order(rows)[["hour", "ip_address"]].itertuples(index=False)]
        seen = (list(self.seen.get()) + new)[: self.first]
        if len(seen) < self.first:
            self.seen.put(seen)
            yield pd.DataFrame(columns=columns)
            return
        self.seen.clear()
        self.done.update((True,))
        frame = pd.DataFrame(seen, columns=["hour", "ip"])

        def common(values: pd.Series) -> list[str]:
            counts = values.dropna().value_counts().rename("n").rename_axis("v").reset_index()
            return [str(v) for v in counts.sort_values(["n", "v"], ascending=[False, True])["v"].head(3)]

        yield pd.DataFrame([(key[0], len(seen), common(frame["ip"]), common(frame["hour"]))], columns=columns)

    def close(self) -> None:
        pass


def user_baselines(stream: DataFrame, first: int = 10) -> DataFrame:
    """(username, n, common_ips, preferred_times), once per user after ``first`` events."""
    rows = stream.where(F.col("username").isNotNull()).select(
        "username", "event_id", "ip_address", F.hour("timestamp").cast("bigint").alias("hour"), micros("timestamp").alias("us")
    )
    return rows.groupBy("username").transformWithStateInPandas(
        FirstEvents(first),
        "username string, n bigint, common_ips array<string>, preferred_times array<string>",
        "Append",
        "None",
    )
