"""Cycles of files that arrive: a cycle comes out when all its files are here, or when its time is over with those that lack.

State is kept by cycle with arbitrary stateful processing: for each frame its first arrival, the deadline, and whether the
cycle is closed. It lives in the query's checkpoint, so a query that is started again goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that such queries need; a fixed value.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Cycle(StatefulProcessor):
    def __init__(self, keys: list[str], expected: list[str], wait: timedelta, keep: timedelta):
        self.keys, self.expected = keys, expected
        self.wait, self.keep = (int(t / timedelta(microseconds=1)) for t in (wait, keep))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getMapState("first", "frame string", "at long")
        self.cycle = handle.getValueState("cycle", "begin long, closed boolean")

    def _row(self, key: tuple, status: str, at: int, got: dict[str, int]) -> pd.DataFrame:
        missing = [f for f in self.expected if f not in got]
        values = dict(zip(self.keys, key, strict=True)) | {"status": status, "n_files": len(got), "missing": ",".join(missing), "decided": pd.Timestamp(at, unit="us", tz="UTC")}
        return pd.DataFrame({k: [v] for k, v in values.items()})

    def _close(self, begin: int) -> None:
        self.first.clear()
        self.cycle.update((begin, True))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(-(-(begin + self.wait + self.keep) // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known = self.cycle.get() if self.cycle.exists() else None
        if known and known[1]:
            for _ in rows:
                pass  # closed: whatever comes again is late
            return
        # The state is asked once a call, not once a row: rows are many, frames are few.
        got = {k[0]: v[0] for k, v in self.first.iterator()}
        came: dict[str, int] = {}
        for pdf in rows:
            for frame, t in pdf.loc[pdf["frame"].isin(self.expected)].groupby("frame")["arrived_micros"].min().items():
                came[frame] = min(int(t), came.get(frame, int(t)))
        for frame, t in came.items():
            if frame not in got or got[frame] > t:
                got[frame] = t
                self.first.updateValue((frame,), (t,))
        if not got:
            return
        begin = min(got.values())
        if known is None or known[0] != begin:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            # Timers are in milliseconds: the first whole one at or after the deadline.
            self.handle.registerTimer(-(-(begin + self.wait) // 1000))
            self.cycle.update((begin, False))
        if len(got) == len(self.expected) and max(got.values()) <= begin + self.wait:
            self._close(begin)
            yield self._row(key, "complete", max(got.values()), got)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        begin, closed = self.cycle.get()
        if closed:
            self.cycle.clear()  # forgotten: nothing of it is expected any more
            return
        deadline = begin + self.wait
        got = {k[0]: v[0] for k, v in self.first.iterator() if v[0] <= deadline}
        self._close(begin)
        yield self._row(key, "timed out", deadline, got)

    def close(self) -> None:
        pass


def complete_cycles(files: DataFrame, keys: list[str], expected: list[str], wait: timedelta, keep: timedelta | None = None, late: str = "1 hour") -> DataFrame:
    """From a stream of (keys, frame, arrived): one row a cycle, with status, n_files, missing (comma-joined) and decided.

    A cycle begins with its first file. It is "complete" as soon as all expected frames are here, each within ``wait`` of
    the first, ``decided`` the last one's arrival; else it is "timed out" ``wait`` after the first, when the watermark, ``late``
    behind the newest arrival, has passed that. Repeated files count once, unexpected frames not at all. Files of a closed cycle are
    passed over until ``keep`` (ten times ``wait``) after its deadline, when its state goes.
    """
    spark = files.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STORE:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    schema = files.select(*keys).schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    rows = files.select(*keys, "frame", F.col("arrived").cast("timestamp").alias("arrived")).where("arrived is not null").withWatermark("arrived", late)
    rows = rows.withColumn("arrived_micros", F.unix_micros("arrived"))
    processor = _Cycle(keys, sorted(set(expected)), wait, keep if keep is not None else 10 * wait)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, f"{schema}, status string, n_files int, missing string, decided timestamp", "append", "eventTime")


def identity_keys(files: DataFrame, name: str = "file") -> DataFrame:
    """Adds what names say to a stream of file names; names of no forecast file go (count them with ``unknown_names``)."""
    from rivulet.functions.text import parse_file_name

    return files.withColumns(parse_file_name(F.col(name))).where("cycle is not null")
