"""MinHash near-duplicate detection with fast similarity sketches, banding and exact verification.

Sketch: coordinate b keeps the smallest (round, value) that lands in its bin. In the first t rounds a shingle's bin is
hashed; in the t rounds after these, round t + b goes to bin b only, so every coordinate fills whatever the set's size,
and a few rounds are enough for large sets. Two sets agree in a coordinate with probability equal to their Jaccard
similarity, concentrated as for t independent hashes.

1. Documents with equal shingle sets become one: the smallest id stands for them.
2. Bands of ``rows`` coordinates are hashed; documents that share a band are candidates. A link at similarity 0.8 goes
   unseen with probability (1 - 0.8**4)**32, about 5e-8.
3. Each member of a band is verified against the smallest id of the band, on the full sets: as many pairs as rows,
   never all pairs. Verified links are joined into components.
4. Where a band still holds several components, its members are compared across components, by their sketches: each pair
   once, in the first band that it shares. Members that have a partner come with their texts, and tasks verify such
   pairs on the full sets, all that their links so far do not connect, and return a forest. Bands are cut into chunks of
   bounded size, so a large one is spread over tasks; pairs inside the largest component are not needed and not made,
   and no step emits pairs by the square.
5. Components of all links.

Edge cases: null and empty texts, and texts without words, have no shingles and link with nothing; fewer words than a
shingle takes make one shingle of them all; rows that repeat a doc_id count as one document with the links of all its
rows and appear once each in the result; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import drop_folder, settle, small_batches, use_checkpoint_dir
from rivulet.llm.graph import connected_components

COORDINATES = 128
ROWS = 4
LINK = 80  # hundredths of similarity
#: A link's sketches agree in 102 coordinates on average, with a deviation of 4.5; less than this is 7 deviations off.
AGREE = 71
FEW, AGREE_FEW = 32, 10  # the same bound for the first coordinates alone
CHUNK = 1024
SALTS = 16
TASK_ROWS = 4096  # members of bands for each task that compares them, about
CACHED_WORDS = 200_000

A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SEEDS = np.random.default_rng(1207).integers(1, 2**63, 2 * COORDINATES, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's word shingles; words are split at ASCII white space, A-Z folded."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if isinstance(text, str) else []
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - self.width + 1)
        out = np.full(n, np.uint64(min(self.width, len(h))))
        for k in range(min(self.width, len(h))):
            out = (out ^ _mix(h[k : k + n] + np.uint64(k * int(B) % 2**64))) * A
        return np.unique(_mix(out))


def sketch(s: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch of a set of hashes: per coordinate the round (upper 16 bits) and the value below it."""
    best = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    # Later rounds never displace earlier ones, so several are made at once: as many as fill all bins for most sets.
    at_once = max(1, min(t, 8 * t // len(s)))
    i = 0
    while i < t and best.max() >= (np.uint64(i) << np.uint64(48)):
        rounds = np.arange(i, min(i + at_once, t))
        h = _mix(s[None, :] ^ SEEDS[rounds][:, None])
        value = (h >> np.uint64(16)) | (rounds.astype(np.uint64) << np.uint64(48))[:, None]
        np.minimum.at(best, (h & np.uint64(t - 1)).astype(np.int64).ravel(), value.ravel())
        i += len(rounds)
    for b in np.flatnonzero(best == np.iinfo(np.uint64).max).tolist():  # round t + b is bin b's alone
        best[b] = ((_mix(s ^ SEEDS[t + b]) >> np.uint64(16)) | (np.uint64(t + b) << np.uint64(48))).min()
    return best


def _sketched(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(width)
        weights = np.array([int(A) ** k % 2**64 for k in range(ROWS)], np.uint64)
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
                s = shingles(text)
                if not len(s):
                    out.append((doc_id, 0, None, None, None))
                    continue
                c = sketch(s).astype(np.uint16)  # bands are made of what is stored, so that two rows tell which bands they share
                bands = _mix((c.astype(np.uint64).reshape(-1, ROWS) * weights).sum(axis=1, dtype=np.uint64) + np.arange(len(c) // ROWS, dtype=np.uint64) * B)
                out.append((doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), c.tobytes(), bands.view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "same", "sketch", "bands"])

    return run


def _verified(width: int, link: int):
    """Pairs with both texts: keeps those whose full sets are similar enough. Sets of recent documents are kept."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(width)
        recent: OrderedDict[str, np.ndarray] = OrderedDict()

        def of(text: str) -> np.ndarray:
            s = recent.get(text)
            if s is None:
                s = recent[text] = shingles(text)
                if len(recent) > 256:
                    recent.popitem(last=False)
            else:
                recent.move_to_end(text)
            return s

        for pdf in batches:
            keep = []
            for ta, tb in zip(pdf["ta"].tolist(), pdf["tb"].tolist(), strict=True):
                x, y = of(ta), of(tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= link * (len(x) + len(y) - both))
            yield pdf.loc[keep, ["a", "b"]]

    return run


def _groups(pdf: pd.DataFrame) -> Iterator[tuple[tuple[int, int, int, int], np.ndarray]]:
    """(kind, x, y, band) and the rows of each pair of chunks in a bundle of them."""
    columns = [pdf[c].to_numpy() for c in ("y", "x", "kind", "key")]
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    at = np.flatnonzero(new)
    kind, x, y, band = (pdf[c].to_numpy() for c in ("kind", "x", "y", "band"))
    for a, z in zip(at.tolist(), [*at[1:].tolist(), len(order)], strict=True):
        k = order[a]
        yield (int(kind[k]), int(x[k]), int(y[k]), int(band[k])), order[a:z]


def _sketches(pdf: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(pdf["sketch"].tolist()), np.uint16).reshape(len(pdf), -1)


def _partners(g: tuple[int, int, int, int], sk: np.ndarray, comp: np.ndarray, n: np.ndarray, largest: np.ndarray, c: np.ndarray, link: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of a chunk (i < j), or of one chunk and another, and in how many coordinates they agree: pairs of
    different components whose sizes and sketches allow a link, and that share no band before this one. In large chunks
    a few coordinates are compared first."""
    kind, x, y, band = g
    inside = kind == 1 and x == y
    first = np.ones(len(sk), bool) if inside else largest if kind == 0 else c == x
    left, right = np.flatnonzero(first), np.arange(len(sk)) if inside else np.flatnonzero(~first)
    if len(left) * len(right) <= 4096:
        i, j = np.repeat(left, len(right)), np.tile(right, len(left))
    else:
        few = np.ascontiguousarray(sk[right][:, :FEW].T)
        found_i, found_j = [], []
        for at in range(0, len(left), 64):
            rows = left[at : at + 64]
            agree = np.zeros((len(rows), len(right)), np.uint8)
            for other, mine in zip(few, sk[rows][:, :FEW].T, strict=True):
                agree += mine[:, None] == other[None, :]
            i, j = np.nonzero(agree >= AGREE_FEW)
            found_i.append(rows[i])
            found_j.append(right[j])
        i, j = np.concatenate(found_i), np.concatenate(found_j)
    ok = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= link * np.maximum(n[i], n[j]))
    if inside:
        ok &= i < j
    i, j = i[ok], j[ok]
    keep, agreed = [np.zeros(0, bool)], [np.zeros(0, np.int64)]
    for at in range(0, len(i), 1 << 14):
        same = sk[i[at : at + (1 << 14)]] == sk[j[at : at + (1 << 14)]]
        earlier = same[:, : ROWS * band].reshape(len(same), band, ROWS).all(axis=2).any(axis=1)
        count = same.sum(axis=1)
        keep.append((count >= AGREE) & ~earlier)
        agreed.append(count)
    ok = np.concatenate(keep)
    return i[ok], j[ok], np.concatenate(agreed)[ok]


def _with_partners(link: int):
    """A bundle of chunk pairs: members that have any partner across components. Only their texts are needed."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = pdf.drop_duplicates(["key", "kind", "x", "y", "id", "sketch"])
        sk, columns = _sketches(m), [m[c].to_numpy() for c in ("comp", "n_shingles", "largest", "c")]
        has = np.zeros(len(m), bool)
        for g, rows in _groups(m):
            if len(rows) > 1:
                i, j, _ = _partners(g, sk[rows], *[c[rows] for c in columns], link)
                has[rows[i]] = True
                has[rows[j]] = True
        return m[has]

    return run


def _linked_across(width: int, link: int):
    """A bundle of chunk pairs: exact links across components, for each as a forest; pairs that it connects already are
    passed over."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shingles = Shingles(width)
        m = pdf.sort_values(["id", "sketch"], kind="stable").reset_index(drop=True)
        ids, texts, sk = m["id"].to_numpy(), m["text"].tolist(), _sketches(m)
        comps, n, largest, c = (m[c].to_numpy() for c in ("comp", "n_shingles", "largest", "c"))
        sets: dict[str, np.ndarray] = {}
        out = []
        for g, rows in _groups(m):
            ii, jj, agree = _partners(g, sk[rows], comps[rows], n[rows], largest[rows], c[rows], link)
            comp = comps[rows].tolist()
            root = {x: x for x in comp}

            def find(x: int) -> int:
                while root[x] != x:  # noqa: B023
                    root[x] = root[root[x]]  # noqa: B023
                    x = root[x]  # noqa: B023
                return x

            if len(sets) > 512:
                sets.clear()
            order = np.argsort(-agree, kind="stable")
            for i, j in zip(ii[order].tolist(), jj[order].tolist(), strict=True):
                x, y = find(comp[i]), find(comp[j])
                if x == y:
                    continue
                both_sets = []
                for t in (texts[rows[i]], texts[rows[j]]):
                    if t not in sets:
                        sets[t] = shingles(t)
                    both_sets.append(sets[t])
                u, v = both_sets
                both = len(np.intersect1d(u, v, assume_unique=True))
                if 100 * both >= link * (len(u) + len(v) - both):
                    out.append((ids[rows[i]], ids[rows[j]]))
                    root[x] = y
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def _chunk_pairs(members: DataFrame, comps: DataFrame, reps: DataFrame) -> tuple[DataFrame, int]:
    """Members of bands that hold several components, once for each pair of chunks (key, g) to compare, and how many rows
    that makes: a member of a large band is in as many as it has chunks to meet."""
    m = members.join(comps.select(F.col("node").alias("id"), "component"), "id", "left").select("key", "band", "id", F.coalesce("component", "id").alias("comp"))
    parts = m.groupBy("key", "band", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("h"))
    bands = parts.groupBy("key", "band").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.sum("h").alias("h"), F.max(F.struct("n", "comp")).alias("top")
    ).where("parts > 1")
    # Of bands with the same members the first one is enough.
    bands = bands.groupBy("n", "h").agg(F.min(F.struct("band", "key", "top")).alias("b")).select("b.key", F.col("b.top.comp").alias("top"), F.col("b.top.n").alias("in_top"), (F.col("n") - F.col("b.top.n")).alias("others"))
    bands = bands.withColumn("tops", F.ceil(F.col("in_top") / CHUNK).cast("int")).withColumn("rests", F.ceil(F.col("others") / CHUNK).cast("int"))
    bands = settle(bands)
    dealt = F.col("in_top") * F.col("rests") + F.col("others") * (F.col("tops") + F.col("rests"))
    rows = bands.agg(F.coalesce(F.sum(dealt), F.lit(0))).first()[0]
    m = m.join(bands, "key").withColumn("largest", F.col("comp") == F.col("top"))
    m = m.withColumn("c", F.pmod(F.xxhash64("id"), F.when(F.col("largest"), F.col("tops")).otherwise(F.col("rests"))).cast("int"))
    rests, tops = F.sequence(F.lit(0), F.col("rests") - 1), F.sequence(F.lit(0), F.col("tops") - 1)
    with_rests = F.transform(rests, lambda r: F.struct(F.lit(0).alias("kind"), F.col("c").alias("x"), r.alias("y")))
    with_tops = F.transform(tops, lambda t: F.struct(F.lit(0).alias("kind"), t.alias("x"), F.col("c").alias("y")))
    inside = F.transform(rests, lambda r: F.struct(F.lit(1).alias("kind"), F.least(r, F.col("c")).alias("x"), F.greatest(r, F.col("c")).alias("y")))
    m = m.select("key", "band", "id", "comp", "largest", "c", F.explode(F.when(F.col("largest"), with_rests).otherwise(F.concat(with_tops, inside))).alias("g"))
    return m.join(reps.select("id", "n_shingles", "sketch"), "id"), rows


def near_duplicates(docs: DataFrame, width: int = 5, link: int = LINK) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept."""
    spark = docs.sparkSession
    small_batches(spark)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    all_ = settle(read.mapInPandas(_sketched(width), "doc_id long, n_shingles long, same binary, sketch binary, bands array<long>"))
    some = all_.where("n_shingles > 0")
    one = some.groupBy("same").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    # Copies meet their smallest id in several tasks, so a large group is spread.
    salted = one.where("n > 1").select("same", "id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = some.select("same", F.col("doc_id").alias("a"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    copies = settle(dealt.join(salted, ["same", "salt"]).where("a != id").select("a", F.col("id").alias("b")).distinct())
    reps = some.join(one.select("same", F.col("id").alias("doc_id")), ["same", "doc_id"], "left_semi").select(F.col("doc_id").alias("id"), "n_shingles", "same", "sketch", "bands")
    banded = reps.select("id", F.posexplode("bands").alias("band", "key")).distinct()
    low = banded.groupBy("key").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = settle(banded.join(low, "key"))
    pairs = members.where("id != low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()

    used = members.select("id").unionByName(members.select(F.col("low").alias("id"))).distinct()
    folder = f"{use_checkpoint_dir(spark)}/near-texts-{uuid.uuid4()}"
    # Rows that repeat an id may differ in text; each is a candidate, and a link of any of them counts.
    read.join(used.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").distinct().write.option("compression", "zstd").parquet(folder)
    texts = spark.read.schema("doc_id long, text string").parquet(folder)

    def links(candidates: DataFrame) -> DataFrame:
        left = candidates.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        both = left.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
        return settle(both.select("a", "ta", "b", "tb").mapInPandas(_verified(width, link), "a long, b long"))

    first = links(pairs)
    sketches = reps.select("id", "n_shingles", "sketch")
    chunks, rows = _chunk_pairs(members.select("key", "band", "id"), connected_components(first), sketches)
    schema = "bundle int, key long, kind int, x int, y int, band int, id long, comp long, largest boolean, c int, n_shingles long, sketch binary"
    # Most bands are small, so a task works through a bundle of them; bundles are sized on the rows that are dealt, with
    # room for what a hash puts together.
    tasks = max(8, members.count() // TASK_ROWS, 3 * int(rows) // (2 * TASK_ROWS))
    bundle = F.pmod(F.xxhash64("key", "g"), F.lit(tasks)).cast("int")
    chunks = chunks.select(bundle.alias("bundle"), "key", "g.*", "band", "id", "comp", "largest", "c", "n_shingles", "sketch")
    open_ = settle(chunks.repartition(tasks, "bundle").groupBy("bundle").applyInPandas(_with_partners(link), schema))
    with_text = open_.join(texts.withColumnRenamed("doc_id", "id"), "id").repartition(tasks, "bundle")
    second = settle(with_text.groupBy("bundle").applyInPandas(_linked_across(width, link), "a long, b long"))
    drop_folder(spark, folder)
    comps = connected_components(first.unionByName(second).unionByName(copies))
    out = all_.select("doc_id", "n_shingles").join(comps.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, link: int = LINK) -> DataFrame:
    """The documents without those that are near copies of one that stays; same columns."""
    gone = near_duplicates(docs, width, link).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
