"""Sharding by size-tiered compaction, in DataFrame functions only.

Arrivals are appended as small immutable shards, one folder of them an append. Shards are ranked into tiers by size,
each tier holding sizes within a factor ``fan`` of each other. Where a tier holds ``fan`` shards or more, its shards are
laid end to end by size and dealt to output files at the target size, each tier to files of its own; one job reads the
merged shards and writes each file in one task, with one shuffle by the file's number. Rounds go on until no tier has
``fan`` shards.

What a reader sees is the newest manifest, a numbered folder with a table of the live shards, their rows and bytes. It is
written under another name, with a file that names its writer, and renamed. A rename onto a folder that exists fails or
moves the new one inside it, so a writer has won if its own name is in the numbered folder; of several writers one wins,
and the others start again from the winner's manifest. This needs what HDFS and local disks have, folder renames in one
step; on object stores the path must be on a layer that has it. A job that dies leaves unreferenced files only. Merged
inputs stay as long as a retained version lists them; ``expire`` says which versions are retained.

Manifests are tables, and places are planned by window functions over them; the driver handles one string a shard that
is merged (as any reader lists its files) and one row a tier.

Sizes are the rows' payload: UTF-8 bytes of the text plus eight bytes of id.

Edge cases: a null text has the size of an empty one and stays null; empty appends add no shard; a row larger than the
target has a shard of its own size; repeated rows stay repeated; columns are kept as they come, any names, as long as
all appends have the same schema; compacting an empty store commits an empty manifest.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.common import fresh

TARGET = 64 << 20
FAN = 4
MANIFEST = "shard string, tier int, n_rows long, n_bytes long"


def row_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


class ShardStore:
    """A folder of shards and manifests in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str, target: int = TARGET, fan: int = FAN):
        self.spark, self.path, self.target, self.fan = spark, path.rstrip("/"), target, fan
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *names: str):
        return self.hadoop.Path("/".join([self.path, *names]))

    def version(self) -> int:
        """The newest committed version; 0 for a new store."""
        folder = self._at("manifests")
        if not self.fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return max([int(n[1:]) for n in names if n.startswith("v")], default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """Live shards of a version: shard (relative path), tier, n_rows, n_bytes."""
        version = self.version() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/v{version:08d}")

    def commit(self, shards: DataFrame, after: int) -> bool:
        """Publishes version after + 1; False if another writer has already."""
        me = str(uuid.uuid4())
        temporary, final = self._at("manifests", f".{me}"), self._at("manifests", f"v{after + 1:08d}")
        shards.select("shard", "tier", "n_rows", "n_bytes").coalesce(1).write.parquet(temporary.toString())
        owner = f"_writer-{me}"
        self.fs.create(self._at("manifests", f".{me}", owner), False).close()
        if not self.fs.exists(final):
            self.fs.rename(temporary, final)
        if self.fs.exists(self._at("manifests", final.getName(), owner)):
            return True
        for lost in (temporary, self._at("manifests", final.getName(), f".{me}")):
            if self.fs.exists(lost):
                self.fs.delete(lost, True)
        return False

    def tier(self, n_bytes: Column) -> Column:
        """0: target size (at least half of it). Further tiers are ``fan`` times smaller each."""
        half = self.target / 2
        return F.when(n_bytes >= half, 0).otherwise(F.ceil(F.log(half / F.greatest(n_bytes, F.lit(1))) / math.log(self.fan))).cast("int")

    def _write(self, df: DataFrame) -> DataFrame:
        """Writes the rows' partitions as new shards; sizes are read back from what was written."""
        folder = f"shards/{uuid.uuid4()}"
        df.write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}")
        name = F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name"))
        sizes = written.groupBy(name.alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(row_bytes(F.col("text"))).alias("n_bytes"))
        return sizes.withColumn("tier", self.tier(F.col("n_bytes")))

    def append(self, df: DataFrame) -> None:
        """Adds an arrival as shards, one for each of its partitions that has rows."""
        new = self._write(df)
        while not self.commit(self.manifest(v := self.version()).unionByName(new), v):
            pass

    def _open(self, shards: list[str], into: str | None = None) -> DataFrame:
        df = self.spark.read.parquet(*[f"{self.path}/{s}" for s in shards])
        return df.withColumn(into, F.regexp_extract("_metadata.file_path", r"(shards/[^/]+/[^/]+)$", 1)) if into else df

    def read(self, version: int | None = None, into: str | None = None) -> DataFrame | None:
        """The rows of a version, in ``into`` the shard they are in; None if it has no shard."""
        shards = [r.shard for r in self.manifest(version).select("shard").collect()]
        return self._open(shards, into) if shards else None

    def compact(self) -> bool:
        """One round: merges every tier that has ``fan`` shards or more. False if there was nothing to merge."""
        version = self.version()
        live = self.manifest(version)
        tiers = [r.tier for r in live.where("tier > 0").groupBy("tier").count().where(F.col("count") >= self.fan).collect()]
        if not tiers:
            if version == 0:
                self.commit(live, 0)
            return False
        # One row a shard: a tier's shards, smallest first, fill files of the target size.
        chosen = live.where(F.col("tier").isin(tiers))
        along = Window.partitionBy("tier").orderBy("n_bytes", "shard").rowsBetween(Window.unboundedPreceding, -1)
        run = F.floor(F.coalesce(F.sum("n_bytes").over(along), F.lit(0)) / self.target)
        placed = chosen.select("shard", F.struct("tier", run.alias("run")).alias("file"))
        numbered = placed.select("file").distinct().withColumn("number", (F.row_number().over(Window.orderBy("file")) - 1).cast("int"))
        placed = placed.join(numbered, "file").select("shard", "number")
        plan = placed.collect()
        merged, files = [r.shard for r in plan], max(r.number for r in plan) + 1
        df = self._open(merged)
        shard, number = fresh(df, "shard"), fresh(df, "number")
        rows = self._open(merged, shard).join(placed.select(F.col("shard").alias(shard), F.col("number").alias(number)), shard)
        new = self._write(rows.repartitionById(files, F.col(number)).select(*[F.col(f"`{c}`") for c in df.columns]))
        left = live.join(placed.select("shard"), "shard", "left_anti").unionByName(new)
        self.commit(left, version)
        return True  # if another writer was first, the next round starts from its manifest

    def compact_all(self, keep: int | None = None) -> int:
        """Rounds until no tier has ``fan`` shards. Each merges ``fan`` shards of a tier into fewer, so there is an end.

        ``keep``: versions that are retained after each round; by default all.
        """
        rounds = 0
        while self.compact():
            rounds += 1
            if keep:
                self.expire(keep)
        return rounds

    def versions(self) -> list[int]:
        """Retained versions, oldest first."""
        folder = self._at("manifests")
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []
        return sorted(int(n[1:]) for n in names if n.startswith("v"))

    def expire(self, keep: int = 1) -> None:
        """Retains the newest ``keep`` versions, and deletes the shards that only older ones list, then these versions.

        A reader of a retained version finds all its shards, whatever is compacted meanwhile.
        """
        if keep < 1:
            raise ValueError("the newest version stays")
        there = self.versions()
        old, kept = there[:-keep], there[-keep:]
        if not old:
            return
        listed = lambda vs: self.spark.read.schema(MANIFEST).parquet(*[f"{self.path}/manifests/v{v:08d}" for v in vs]).select("shard").distinct()
        for r in listed(old).join(listed(kept), "shard", "left_anti").toLocalIterator():
            self.fs.delete(self._at(r.shard), False)
        for v in old:
            self.fs.delete(self._at("manifests", f"v{v:08d}"), True)


def shard_documents(docs: DataFrame, path: str, arrivals: int = 4, target: int = TARGET, fan: int = FAN) -> ShardStore:
    """Appends the documents in ``arrivals`` parts (by a hash of the id, as if they came one after the other), then compacts."""
    store = ShardStore(docs.sparkSession, path, target, fan)
    for k in range(arrivals):
        store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(arrivals)) == k))
    store.compact_all(keep=1)  # nobody reads the versions on the way
    return store


def assignments(store: ShardStore) -> DataFrame:
    """One row a document of the newest version, read back from its shards: doc_id, shard, n_bytes, shard_bytes, tier, version."""
    version = store.version()
    rows = store.read(version)
    if rows is None:
        return store.spark.createDataFrame([], "doc_id long, shard string, n_bytes long, shard_bytes long, tier int, version long")
    shard = fresh(rows, "shard")
    out = store.read(version, shard).select("doc_id", F.col(shard).alias("shard"), row_bytes(F.col("text")).alias("n_bytes"))
    listed = store.manifest(version).select("shard", F.col("n_bytes").alias("shard_bytes"), "tier")
    return out.join(listed, "shard").select("doc_id", "shard", "n_bytes", "shard_bytes", "tier", F.lit(version).cast("long").alias("version"))
