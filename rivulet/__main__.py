"""Command line: run a profile over tables, print its plan, list profiles that can't be read, or the settings.

    python -m rivulet run profile.json --input cells.parquet --dims feature_id,time --table thresholds=t.parquet --output out
    python -m rivulet summarize profile.json
    python -m rivulet validate folder
    python -m rivulet settings
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rivulet.model import from_table
from rivulet.plans.operations import REGISTRY, Context
from rivulet.plans.profile import Profile, find_invalid
from rivulet.sources.netcdf import read_netcdf
from rivulet.sources.scan import read_table, with_identity


def _profile(spark: SparkSession, path: str) -> Profile:
    return Profile.from_json(spark.read.text(path, wholetext=True).first()[0], path.rpartition("/")[2])


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="rivulet", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run")
    run.add_argument("profile")
    run.add_argument("--input", required=True, nargs="+")
    run.add_argument("--dims", default="feature_id,time")
    run.add_argument("--coords", default="")
    run.add_argument("--table", action="append", default=[], metavar="NAME=PATH")
    run.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
    run.add_argument("--output", default=".")
    run.add_argument("--file-names", action="store_true", help="add what the files' names say as columns")
    run.add_argument("--explain", action="store_true")
    commands.add_parser("summarize").add_argument("profile")
    commands.add_parser("validate").add_argument("folder")
    commands.add_parser("settings")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("rivulet").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "settings":
        print("\n".join(f"{k}={v}" for k, v in sorted(spark.sparkContext.getConf().getAll())))
        print("operations: " + ", ".join(sorted(REGISTRY)))
        return 0
    if a.command == "summarize":
        print(_profile(spark, a.profile).summary())
        return 0
    if a.command == "validate":
        bad = find_invalid(spark, a.folder)
        print("\n".join(f"{p}: {why}" for p, why in bad.items()) or "all can be read")
        return int(bool(bad))
    netcdf = all(p.endswith(".nc") for p in a.input)
    df = read_netcdf(spark, ",".join(a.input)) if netcdf else read_table(spark, a.input)
    df = with_identity(df, F.col("file") if netcdf else None) if a.file_names else df
    tables = {n: spark.read.parquet(p) for n, _, p in (t.partition("=") for t in a.table)}
    context = Context(tables=tables, values={n: v for n, _, v in (s.partition("=") for s in a.set)}, output=a.output)
    out = _profile(spark, a.profile).run(from_table(df, a.dims.split(","), [c for c in a.coords.split(",") if c]), context)
    if a.explain:
        out.df.explain("formatted")
    print("\n".join(context.saved) or f"{out.df.count()} cells")
    return 0


if __name__ == "__main__":
    sys.exit(main())
