"""Profiles: what is run for which files, from JSON to results."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.model import Dataset
from rivulet.plans.operations import Context, Operation, PlanError, load_operation, run_all

log = logging.getLogger(__name__)
IDENTITY = ("region", "configuration", "output_type", "member")


@dataclass
class Profile:
    """An ordered tree of operations for the files of one region, configuration, output type and maybe member."""

    name: str
    operations: list[Operation]
    region: str = ""
    configuration: str = ""
    output_type: str = ""
    member: str | None = None
    metadata: dict = field(default_factory=dict)

    def __post_init__(self):
        self.operations = [load_operation(o) for o in self.operations]
        if not self.operations:
            raise PlanError(f"{self.name} has no operations")
        for k, o in enumerate(self.operations, 1):
            o.assign_ids(str(k))

    @classmethod
    def from_dict(cls, spec: dict, name: str = "profile") -> Profile:
        known = {k: spec[k] for k in ("region", "configuration", "member", "metadata") if spec.get(k) is not None}
        return cls(name=spec.get("name") or name, operations=spec.get("operations") or spec.get("process") or [], output_type=spec.get("output_type") or spec.get("model_output_type") or "", **known)

    @classmethod
    def from_json(cls, text: str, name: str = "profile") -> Profile:
        return cls.from_dict(json.loads(text), name)

    def summary(self) -> str:
        return "\n".join([self.name, *[o.summary(1) for o in self.operations]])

    def run(self, data: Dataset, context: Context | None = None, debug: bool = False, on_complete: list[Callable] | None = None, **metadata) -> Dataset:
        """Builds the plan and runs its sinks; the result is the last operation's dataset, not yet computed."""
        disabled = [f"{o.operation_id} {o.name}" for top in self.operations for o in top.walk() if o.disable]
        if disabled and not debug:
            raise PlanError(f"disabled: {', '.join(disabled)}")
        context = context or Context()
        own = {k: v for k, v in zip(IDENTITY, (self.region, self.configuration, self.output_type, self.member), strict=True) if v}
        context = replace(context, values={**own, **self.metadata, **metadata, **context.values})
        return run_all(self.operations, replace(data, metadata={**data.metadata, **own}), context, debug, on_complete)


def load_profiles(spark: SparkSession, folder: str) -> dict[str, Profile]:
    """All *.json profiles of a folder in any file system; unreadable ones are passed over with a warning."""
    out, bad = {}, find_invalid(spark, folder)
    for path, text in _texts(spark, folder):
        if path in bad:
            log.warning("%s: %s", path, bad[path])
        else:
            out[path] = Profile.from_json(text, path.rpartition("/")[2])
    if not out:
        raise FileNotFoundError(f"no profile can be read in {folder}")
    return out


def find_invalid(spark: SparkSession, folder: str) -> dict[str, str]:
    bad = {}
    for path, text in _texts(spark, folder):
        try:
            Profile.from_json(text)
        except (ValueError, KeyError, TypeError, AttributeError) as e:
            bad[path] = str(e)
    return bad


def profile_table(spark: SparkSession, folder: str) -> DataFrame:
    """One row a profile of a folder: name, region, configuration, output_type, member, and what is wrong with it (or null)."""
    rows, bad = [], find_invalid(spark, folder)
    for path, text in _texts(spark, folder):
        p = None if path in bad else Profile.from_json(text)
        rows.append((path.rpartition("/")[2], *([p.region, p.configuration, p.output_type, p.member] if p else [None] * 4), bad.get(path)))
    return spark.createDataFrame(rows, "name string, region string, configuration string, output_type string, member string, fault string")


def with_profile(files: DataFrame, profiles: DataFrame) -> DataFrame:
    """Adds ``profile``, the name of the sound profile for each file's identity; null where there is none. A profile without
    a member is for all of them. The profiles' table is as long as a folder's list."""
    sound = profiles.where("fault is null").select(F.col("name").alias("profile"), *[F.col(k).alias(f"__{k}") for k in IDENTITY])
    same = F.lit(True)
    for k in IDENTITY[:3]:
        same = same & (F.col(k) == F.col(f"__{k}"))
    same = same & (F.col("__member").isNull() | (F.col("member") == F.col("__member")))
    return files.join(sound, same, "left").drop(*[f"__{k}" for k in IDENTITY])


def trace(profile: Profile, data: Dataset, context: Context | None = None) -> DataFrame:
    """(id, operation, rows): how many rows there are after each of a profile's operations; one count each."""
    context = context or Context()
    out = None
    for o in profile.operations:
        data = o.apply(data, context)
        one = data.df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(o.operation_id).alias("id"), F.lit(o.name).alias("operation"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def _texts(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    rows = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).selectExpr("_metadata.file_path AS path", "value")
    return [(r["path"], r["value"]) for r in rows.orderBy("path").collect()]


def select_profile(profiles: dict[str, Profile], region: str, configuration: str, output_type: str, member: str | None = None) -> Profile:
    found = [p for p in profiles.values() if (p.region, p.configuration, p.output_type) == (region, configuration, output_type) and (p.member is None or str(p.member) == str(member))]
    if len(found) != 1:
        raise KeyError(f"{len(found)} profiles for {region} {configuration} {output_type} {member or ''}")
    return found[0]


def one_identity(df: DataFrame) -> dict[str, str | None]:
    """The identity that all files share; ValueError if there are several."""
    rows = df.select(*IDENTITY, "cycle").distinct().limit(2).collect()
    if len(rows) != 1:
        raise ValueError("no files" if not rows else "files of several configurations")
    return rows[0].asDict()
