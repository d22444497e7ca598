import threading

from rivulet.llm.sharding import ShardStore, assignments, shard_documents

SCHEMA = "doc_id long, text string, shard string, number int"


def same_rows(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_round_trip_tiers_and_versions(spark, small, tmp_path):
    df = spark.read.parquet(f"{small}/documents.parquet").repartition(6)
    store = shard_documents(df, str(tmp_path / "s"), target=100_000)
    assert same_rows(store.read(), df)
    live = store.manifest().collect()
    tiers = [s.tier for s in live]
    assert all(tiers.count(t) < store.fan for t in set(tiers) - {0}) and tiers.count(0) > 3
    assert sum(s.n_rows for s in live) == df.count()
    assert store.version() >= 5
    rows = assignments(store).collect()
    by_shard = {}
    for r in rows:
        by_shard[r.shard] = by_shard.get(r.shard, 0) + r.n_bytes
        assert r.version == store.version()
    assert by_shard == {s.shard: s.n_bytes for s in live}
    on_disk = {f"shards/{p.parent.name}/{p.name}" for p in (tmp_path / "s" / "shards").rglob("*.parquet")}
    assert on_disk == set(by_shard)


def test_tiers_merge_apart(spark, tmp_path):
    store = ShardStore(spark, str(tmp_path / "s"), target=100_000)
    for size in [10_000] * 4 + [2_000] * 4:
        store.append(spark.createDataFrame([(size, "t" * size, "x", 1)], SCHEMA).coalesce(1))
    assert sorted(r.tier for r in store.manifest().collect()) == [2] * 4 + [3] * 4
    assert store.compact()
    shards = {r.shard: r.n_bytes for r in store.manifest().collect()}
    assert sorted(shards.values()) == [4 * 2_008, 4 * 10_008]
    assert not store.compact()


def test_many_small_shards_end_in_target_sized_ones(spark, tmp_path):
    store = ShardStore(spark, str(tmp_path / "s"), target=5_000, fan=2)
    df = spark.range(400).selectExpr("id doc_id", "repeat('a', 92) text", "'s' shard", "1 number")
    store.append(df.repartition(60))
    store.compact_all()
    live = store.manifest().collect()
    assert same_rows(store.read(), df) and len([s for s in live if s.tier]) <= 3
    assert max(s.n_bytes for s in live) <= 7_500


def test_of_two_writers_one_wins(spark, tmp_path):
    a, b = (ShardStore(spark, str(tmp_path / "s"), target=10_000) for _ in range(2))
    df = spark.createDataFrame([(i, "t" * 100, "x", 1) for i in range(50)], SCHEMA)
    a.append(df)
    v = a.version()
    assert a.commit(a.manifest(), v) and not b.commit(b.manifest().where("false"), v)
    assert b.version() == v + 1 and b.manifest().count() == a.manifest(v).count()
    for _ in range(3):  # at the same time
        v, won = a.version(), []
        writers = [threading.Thread(target=lambda s=s, v=v: won.append(s.commit(s.manifest(v), v))) for s in (a, b, a, b)]
        for w in writers:
            w.start()
        for w in writers:
            w.join()
        assert sorted(won) == [False, False, False, True] and a.version() == v + 1
    appends = [threading.Thread(target=lambda s=s, k=k: s.append(df.withColumn("number", df.number + k))) for k, s in enumerate((a, b, a))]
    for w in appends:
        w.start()
    for w in appends:
        w.join()
    assert a.read().count() == 200
    folder = tmp_path / "s" / "manifests"
    assert not [p for p in folder.rglob(".*-*") if p.is_dir()]


def test_edges(spark, tmp_path):
    rows = [(1, None, "a", 1), (2, "", None, None), (3, "big" * 100_000, "b", 2), (4, "é", "c", 3), (4, "é", "c", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    store = shard_documents(df, str(tmp_path / "s"), target=1000, fan=2)
    assert same_rows(store.read(), df) and store.read().columns == df.columns
    got = {(r.doc_id, r.n_bytes) for r in assignments(store).collect()}
    assert got == {(1, 8), (2, 8), (3, 300_008), (4, 10)} and assignments(store).count() == 5
    empty = shard_documents(df.where("false"), str(tmp_path / "e"))
    assert empty.manifest().collect() == [] and assignments(empty).collect() == [] and empty.version() > 0


def test_readers_of_retained_versions_find_their_rows(spark, tmp_path):
    store = ShardStore(spark, str(tmp_path / "s"), target=100_000)
    parts = [spark.createDataFrame([(10 * k + i, "t" * 9000, "x", k) for i in range(2)], SCHEMA).coalesce(1) for k in range(5)]
    for p in parts:
        store.append(p)
    before, reader = store.version(), store.read()
    assert store.compact_all() > 0 and store.version() > before
    assert reader.count() == 10 and same_rows(store.read(before), store.read()) and store.read(2).count() == 4
    assert store.versions() == list(range(1, store.version() + 1))
    store.expire(2)
    assert store.versions() == [store.version() - 1, store.version()] and same_rows(store.read(store.version() - 1), store.read())
    store.expire()
    listed = {r.shard for r in store.manifest().collect()}
    assert {f"shards/{p.parent.name}/{p.name}" for p in (tmp_path / "s" / "shards").rglob("*.parquet")} == listed
    assert store.read().count() == 10
