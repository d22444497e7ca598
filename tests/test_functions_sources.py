"""Column functions, scans, sinks and streams, with hand-made values."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rivulet.functions import calendar, text, units
from rivulet.model import from_table
from rivulet.operators.masks import half_open, include_conditions, nearest, partition, reindex
from rivulet.sources import scan, sinks
from rivulet.streaming.folds import lead_windows, read_stream, write_stream


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], schema).select(column).collect()]


def test_file_names(spark):
    names = ["nwm.t06z.short_range.channel_rt.f018.conus.nc", "nwm.t00z.analysis_assim.land_1.tm02.hawaii.nc", "nwm.t00z.short_range.channel_rt.f00115.hawaii.nc", "other.nc"]
    df = scan.with_identity(spark.createDataFrame([(n,) for n in names], "n string"), F.col("n"))
    got = [(r.cycle, r.configuration, r.output_type, r.member, r.frame, r.region, r.lead_seconds) for r in df.collect()]
    assert got[0] == ("06", "short_range", "channel_rt", None, "f018", "conus", 64800)
    assert got[1] == ("00", "analysis_assim", "land", "1", "tm02", "hawaii", -7200)
    assert got[2][-1] == 4500 and set(got[3]) == {None}
    again = df.where("region is not null").select(text.render_file_name(*[F.col(c) for c in ("cycle", "configuration", "output_type", "member", "lead_seconds", "region")]))
    assert [r[0] for r in again.collect()] == [names[0], "nwm.t00z.analysis_assim.land_1.tm0200.hawaii.nc", names[2]]
    assert values(spark, text.frame_token(F.col("x")), names) == ["f018", "tm02", "f00115", None]
    assert values(spark, text.strip_stage(F.col("x")), ["3.1_a_b", "12_x", "a_1"]) == ["a_b", "x", "a_1"]
    g = text.named_groups(F.col("x"), r"mask_(?P<rfc>[A-Z]+)_(?P<v>\d)?")
    assert values(spark, g["rfc"], ["mask_OHRFC_1", "none"]) == ["OHRFC", None]


def test_templates_and_titles(spark):
    assert text.template_variables("{a}/{b:02d}/{a}/{{no}}") == ["a", "b"]
    assert text.fill_template("{a}-{b:03d}", {"a": None, "b": 7}, {"a": "x"}) == "x-007"
    with pytest.raises(ValueError):
        text.fill_template("{zz}", {})
    assert values(spark, text.titled(F.col("x")), ["streamFlow_max-value", "a"]) == ["Stream Flow Max Value", "A"]
    assert values(spark, text.human_bytes(F.col("x")), [999, 1500, 2_500_000], "x long") == ["999.00 B", "1.50 KB", "2.50 MB"]
    assert values(spark, text.literal_type(F.col("x")), ["1", "3000000000", "5LL", "1.5f", ".5", '"a"', "b"]) == ["int", "int64", "int64", "float", "double", "char", "char"]
    assert text.widest_type("byte", "i") == "int" and text.netcdf_type("uint8") == "ubyte"
    for call in (lambda: text.widest_type("int", "float"),):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(KeyError):
        text.netcdf_type("blob")


def test_days_and_durations(spark):
    days = values(spark, calendar.universal_day(F.col("x")), [datetime(2023, 2, 28), datetime(2023, 3, 1), datetime(2024, 3, 1), datetime(2023, 12, 31), datetime(1900, 3, 1)], "x timestamp")
    assert days == [59, 61, 61, 366, 61]
    assert values(spark, calendar.duration_seconds(F.col("x")), ["P1DT2H", "PT30S", "P", "x", "PT1.5S"]) == [93600.0, 30.0, None, None, 1.5]
    assert calendar.parse_duration("P1DT1M") == timedelta(days=1, minutes=1)
    with pytest.raises(ValueError):
        calendar.parse_duration("1 hour")


def test_packing_and_units(spark):
    x = [1.234, None, float("nan"), 3e9, -0.005, 0.015]
    assert values(spark, units.pack(F.col("x")), x, "x double") == [123, -99900, -99900, -99900, 0, 2]
    assert values(spark, units.unpack(F.col("x")), [123, -99900], "x int") == [1.23, None]
    assert units.time_multiplier(2, "hours", "minutes") == 120
    with pytest.raises(ValueError):
        units.find_conversion("1", "2")


def test_filters_and_reindex(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, None, 7.0), (2, "b", 6.0), (4, "c", 1.0)], "id long, s string, v double")
    assert [r.id for r in df.where(include_conditions({"s": "a"})).collect()] == [1, 2]
    yes, no = partition(df, F.col("s") == "a")
    assert (yes.count(), no.count()) == (1, 3)
    assert df.where(half_open("id", 2, 4)).count() == 2 and df.where(half_open("id", None, None)).count() == 4
    assert nearest(df, "v", 6.5).first().v == 6.0
    out = reindex(df, spark.createDataFrame([(1,), (2,), (3,)], "id long"), "id", {"v": -1.0}, "v")
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, 5.0), (2, 6.0), (3, -1.0)]


def test_scans(spark, tmp_path):
    for frame in ("f001", "f002"):
        spark.createDataFrame([(1, 2.0)], "feature_id long, flow double").write.parquet(str(tmp_path / f"nwm.t00z.short_range.channel_rt.{frame}.conus.nc.parquet"))
    with pytest.raises(ValueError):
        scan.read_cycle(spark, str(tmp_path), "00", "short_range", "channel_rt", "conus", expected=18)
    (tmp_path / "log.txt").write_text("2024-01-01 00:00:00 | a.py | 12 | x.y | f | f(1) | done | 9.5 | 77\n2024-01-02 00:00:00 | a.py | 12 | x.y | f | f(1) | done | 8.5\nnoise\n")
    t = scan.read_timing_log(spark, str(tmp_path / "log.txt")).orderBy("date").collect()
    assert [(r.function, r.line, r.duration, r.pid) for r in t] == [("f", 12, 9.5, 77), ("f", 12, 8.5, None)]
    df = spark.createDataFrame([(1, 5, 0.5), (1, 365, 0.6), (2, 200, 0.7)], "feature_id long, day int, p05 double")
    assert scan.daily_thresholds(df, "p05", 360, 10).count() == 2 and scan.daily_thresholds(df, "p05", 1, 10).count() == 1
    with pytest.raises(KeyError):
        scan.select_label(df, {"none": 1})
    assert scan.expand_paths(["{m}/*.nc"], {"m": "a"}) == ["a/*.nc"]
    with pytest.raises(ValueError):
        scan.expand_paths(["{m}"], {})
    assert scan.similar_names("x.b.nc", ["a.b.nc", "q.txt"])[0] == "a.b.nc"
    assert values(spark, scan.is_netcdf(F.col("x")), [b"CDF\x01..", b"\x89HDF", b"PK"], "x binary") == [True, True, False]
    links = spark.createDataFrame([(1, 2), (1, 2), (2, -1)], "from long, to long")
    links.write.parquet(str(tmp_path / "links"))
    assert scan.read_links(spark, str(tmp_path / "links"), link="from").count() == 2
    one = from_table(spark.createDataFrame([(1, datetime(2024, 5, 6, 7))], "feature_id long, time timestamp"), ("feature_id", "time"), attrs={"a": "b"}, var_attrs={"time": {"u": "s"}})
    meta = scan.load_metadata(one, ["time"])
    assert (meta["a"], meta["time.u"], meta["time__date"], meta["time__hour"]) == ("b", "s", "20240506", "07")


def test_default_encoding(spark):
    data = from_table(spark.createDataFrame([(1, 2.345)], "k long, v double"), ("k",), encoding={"v": {"scale_factor": 0.1}})
    assert sinks.default_encoding(data)["v"]["_FillValue"] == -99900 and sinks.packed(data).first().v == 23


def test_stream_folds_equal_the_batch(spark, tmp_path):
    rows = [(1, datetime(2024, 1, 1, 0, 0), 1.0), (1, datetime(2024, 1, 1, 1, 0), 2.0), (1, datetime(2024, 1, 1, 1, 0, 1), 4.0), (2, datetime(2024, 1, 1, 1, 0), 8.0), (1, datetime(2024, 1, 3), 0.0)]
    df = spark.createDataFrame(rows, "k long, ts timestamp, v double")
    df.write.parquet(str(tmp_path / "in"))
    folds = [("v", "sum", "s"), ("v", "mean", "m")]
    out = lead_windows(read_stream(spark, str(tmp_path / "in"), df.schema), "ts", "1 hour", ["k"], folds, "0 seconds")
    q = write_stream(out, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = sorted((r.k, r.window_end, r.s) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, datetime(2024, 1, 1, 0), 1.0), (1, datetime(2024, 1, 1, 1), 2.0), (1, datetime(2024, 1, 1, 2), 4.0), (2, datetime(2024, 1, 1, 1), 8.0)]
    with pytest.raises(KeyError):
        lead_windows(df, "ts", "1 hour", ["k"], [("v", "median", "m")])


def test_dotted_output_types(spark, tmp_path):
    df = spark.range(4)
    for kind in ("reservoir", "reservoir.full", "reservoir.full_2"):
        df.withColumn("kind", F.lit(kind)).coalesce(1).write.parquet(str(tmp_path / f"nwm.t00z.short_range.{kind}.f001.conus.nc.parquet"))
    for kind, member in (("reservoir", None), ("reservoir.full", None), ("reservoir.full", "2")):
        rows = scan.read_cycle(spark, str(tmp_path), "00", "short_range", kind, "conus", member=member).where(F.col("member").eqNullSafe(F.lit(member))).collect()
        assert {(r.kind, r.output_type, r.frame) for r in rows} == {(kind + ("_" + member if member else ""), kind, "f001")} and len(rows) == 4


def test_scratch_folder_is_shared_or_local(spark):
    assert sinks.scratch_folder(spark) != sinks.scratch_folder(spark)
