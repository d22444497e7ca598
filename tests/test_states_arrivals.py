"""Kept states against one pass, a stream's restarts and replays, cycles against a plain event loop."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from rivulet.operators import states
from rivulet.operators.aggregates import fold_cells
from rivulet.plans.profile import one_identity
from rivulet.sources.scan import unknown_names, with_identity
from rivulet.streaming import arrivals, folds

FOLDS = [("v", op, op) for op in ("count", "sum", "min", "max", "mean", "variance", "std", "variance_sample")]


def rows_of(spark, seed, n=400):
    rng = random.Random(seed)
    rows = [(rng.randrange(12), None if rng.random() < 0.2 or k % 12 == 5 else 1e6 + rng.gauss(0, 3)) for k in range(n)] + [(99, None), (98, 5.0)]
    return spark.createDataFrame(rows, "cell int, v double")


def same(a, b):
    have, want = ({r.cell: r.asDict() for r in x.collect()} for x in (a, b))
    assert have.keys() == want.keys()
    for k, w in want.items():
        for name, x in w.items():
            assert (have[k][name] is None) == (x is None), (k, name)
            assert x is None or have[k][name] == pytest.approx(x, rel=1e-7, abs=1e-7), (k, name)


def test_merged_parts_equal_one_pass(spark):
    parts = [rows_of(spark, s) for s in (1, 2, 3)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    made = [states.fold_state(p, ["cell"], FOLDS) for p in [*parts, whole.limit(0)]]
    once = states.merge_states(made, ["cell"], FOLDS)
    nested = states.merge_states([states.merge_states(made[:2], ["cell"], FOLDS), made[2]], ["cell"], FOLDS)
    want = fold_cells(whole, ["cell"], FOLDS)
    for state in (once, nested, states.fold_state(whole, ["cell"], FOLDS)):
        same(states.finish(state, ["cell"], FOLDS), want)
    with pytest.raises(KeyError, match="kept state"):
        states.fold_state(whole, ["cell"], [("v", "mode", "m")])


def test_median_within_its_error(spark):
    df = spark.range(60_000).select((F.col("id") % 2).cast("int").alias("cell"), (F.xxhash64("id") % 1000003).cast("double").alias("v"))
    wanted = [("v", "median", "m"), ("v", "count", "n")]
    parts = [states.fold_state(df.where(F.pmod(F.xxhash64("v"), F.lit(3)) == k), ["cell"], wanted) for k in range(3)]
    for r in states.finish(states.merge_states(parts, ["cell"], wanted), ["cell"], wanted).collect():
        below = df.where((F.col("cell") == r.cell) & (F.col("v") < r.m)).count()
        assert abs(below / r.n - 0.5) <= states.SKETCH_ERROR
    none = states.finish(states.fold_state(spark.createDataFrame([(1, None)], "cell int, v double"), ["cell"], wanted), ["cell"], wanted).first()
    assert none.m is None and none.n == 0
    empty = states.fold_state(spark.createDataFrame([(1, None)], "cell int, v double"), ["cell"], wanted)
    assert states.finish(states.merge_states([empty, parts[0]], ["cell"], wanted), ["cell"], wanted).where("cell = 1").first().n > 0


def test_store_replays_and_expires(spark, tmp_path):
    store = states.StateStore(spark, str(tmp_path / "s"), ["cell"], FOLDS)
    assert store.read() is None and store.result() is None
    a, b = rows_of(spark, 1), rows_of(spark, 2)
    assert store.add(a) == 1 and store.add(b) == 2
    want = fold_cells(a.unionByName(b), ["cell"], FOLDS)
    same(store.result(), want)
    assert store.add(b, 2) == 2  # the same batch once more
    same(store.result(), want)
    (tmp_path / "s" / f"v{3:012d}").mkdir()  # a version that was never finished
    assert store.versions() == [1, 2]
    store.add(a)
    store.expire(1)
    assert store.versions() == [3]


def test_stream_of_states_restarts(spark, tmp_path):
    store = states.StateStore(spark, str(tmp_path / "s"), ["cell"], [*FOLDS, ("v", "median", "median")])
    whole = None
    for k in range(3):
        part = rows_of(spark, k)
        part.write.mode("append").parquet(str(tmp_path / "in"))
        whole = part if whole is None else whole.unionByName(part)
        stream = folds.read_stream(spark, str(tmp_path / "in"), part.schema)
        states.fold_stream(stream, store, str(tmp_path / "c")).awaitTermination()
        same(store.result().drop("median"), fold_cells(whole, ["cell"], FOLDS))
    exact = {r.cell: r.m for r in fold_cells(whole, ["cell"], [("v", "median", "m")]).collect()}
    assert all(r.median is None if exact[r.cell] is None else abs(r.median - exact[r.cell]) < 1 for r in store.result().collect())


def plain_cycles(files, expected, wait):
    """All files in the order of their arrival, as one after the other."""
    by: dict = {}
    for key, frame, at in sorted(files, key=lambda f: f[2]):
        if frame in expected:
            by.setdefault(key, {}).setdefault(frame, at)
    out = {}
    for key, got in by.items():
        deadline = min(got.values()) + wait
        here = {f: t for f, t in got.items() if t <= deadline}
        out[key] = ("complete", len(here), "", max(here.values())) if len(here) == len(expected) else ("timed out", len(here), ",".join(sorted(set(expected) - set(here))), deadline)
    return out


def test_cycles_against_a_plain_loop(spark, tmp_path):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    expected = ["f001", "f002", "f003"]
    files = []
    for cycle in range(40):
        begin = start + timedelta(hours=3 * cycle)
        for frame in ["f001", "f002", "f003", "f009"]:
            if rng.random() < 0.85:
                files.append((f"{cycle:02d}", frame, begin + timedelta(minutes=rng.randrange(0, 300))))
        files.append((f"{cycle:02d}", "f001", begin + timedelta(minutes=rng.randrange(0, 600))))
    files.sort(key=lambda f: f[2])
    end = ("99", "f001", files[-1][2] + timedelta(days=9))  # moves the watermark past all others
    want = plain_cycles(files, expected, timedelta(hours=2))
    schema = "cycle string, frame string, arrived timestamp"
    lots = [files[k : k + 30] for k in range(0, len(files), 30)]
    for lot in [*lots, [end]]:
        spark.createDataFrame(lot, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = folds.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        done = arrivals.complete_cycles(stream, ["cycle"], expected, timedelta(hours=2), timedelta(days=300), late="5 hours")
        folds.write_stream(done, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    have = {r.cycle: (r.status, r.n_files, r.missing, r.decided.astimezone(timezone.utc).replace(tzinfo=None)) for r in rows}
    assert len(rows) == len(have) and have == want
    assert {w[0] for w in want.values()} == {"complete", "timed out"}


def test_names_and_identity(spark):
    names = ["nwm.t06z.short_range.land.f001.alaska.aprfc.nc", "nwm.t06z.short_range.land.f002.alaska.aprfc.nc", "other.nc", "other.nc", "nwm.t06z.short_range.land.f001.conus.xyrfcx.nc"]
    files = spark.createDataFrame([(n,) for n in names], "file string")
    assert {(r.file, r.n) for r in unknown_names(files).collect()} == {("other.nc", 2), ("nwm.t06z.short_range.land.f001.conus.xyrfcx.nc", 1)}
    keyed = arrivals.identity_keys(files)
    assert {r.region for r in keyed.collect()} == {"alaska.aprfc"} and keyed.count() == 2
    assert one_identity(with_identity(files.limit(2), F.col("file")))["region"] == "alaska.aprfc"
    mixed = spark.createDataFrame([(names[0],), ("nwm.t06z.short_range.land.f001.alaska.nc",)], "file string")
    with pytest.raises(ValueError, match="several"):
        one_identity(with_identity(mixed, F.col("file")))
    with pytest.raises(ValueError, match="no files"):
        one_identity(with_identity(files.limit(0), F.col("file")))


def test_state_is_asked_once_a_call_not_once_a_row():
    import pandas as pd

    calls = []

    class Held:
        def __init__(self):
            self.value = {}

        def __getattr__(self, name):
            def call(*a):
                calls.append(name)
                if name == "iterator":
                    return iter(list(self.value.items()))
                if name in ("containsKey", "exists"):
                    return a[0] in self.value if a else bool(self.value)
                if name == "updateValue":
                    self.value[a[0]] = a[1]
                if name == "getValue":
                    return self.value[a[0]]
                return iter(()) if name == "listTimers" else None

            return call

    held = Held()
    held.getMapState = held.getValueState = lambda *a: held
    cycle = arrivals._Cycle(["day"], ["f001", "f002"], timedelta(hours=1), timedelta(hours=1))
    cycle.init(held)
    held.value.clear()
    start = datetime(2024, 1, 1)
    at = [start + timedelta(seconds=(7 * k) % 5000) for k in range(5000)]
    lot = pd.DataFrame({"frame": ["f001", "f003"] * 2500, "arrived": pd.to_datetime(at), "arrived_micros": [int((t - datetime(1970, 1, 1)) / timedelta(microseconds=1)) for t in at]})
    assert list(cycle.handleInputRows(("d",), iter([lot[:2000], lot[2000:]]), None)) == []
    first = min(int((t - datetime(1970, 1, 1)) / timedelta(microseconds=1)) for t in at[::2])
    assert held.value == {("f001",): (first,)} and len(calls) < 20
