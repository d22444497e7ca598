"""Every query with SQL against DuckDB on the same tables."""

import math

import duckdb
import pytest

from rivulet.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


def test_all_have_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    cur = duck.execute(SQL[name])
    names = sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(n) for n in names]
    want = sorted(tuple(plain(r[k]) for k in at) for r in cur.fetchall())
    df = QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == names
    have = sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
    assert len(have) == len(want) > 0
    assert have == want, [x for x in zip(have, want) if x[0] != x[1]][:3]


def test_anomaly_on_the_mean_itself_and_of_nothing(spark, tmp_path):
    """A value that equals its mean, in whatever order it is added, and rows without value or user, as the SQL has them."""
    values = {1: [29.27], 2: [0.1, 0.2, 0.3], 3: [0.7] * 10 + [0.1, 1.3], 4: [1e-20], 5: [1e300], 6: [None], 7: [2.0, None, 4.0], None: [1.0]}
    rows = [(u, v) for u, held in values.items() for v in held]
    rows = [(k, "2024-01-01 00:00:00", u, "view", v) for k, (u, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    df.withColumn("ts", df["ts"].cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    out = {r.event_id: r.value for r in QUERIES["anomaly_attributes"](spark, str(tmp_path)).collect()}
    means = {1: 29.27, 2: 0.2, 3: 0.7, 4: 1e-20, 5: 1e300, 7: 3.0}
    assert out == {k: None if v is None else -1.0 if v <= means[u] else 1.0 for k, _, u, _, v in rows if u is not None}
