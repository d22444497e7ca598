"""Projections against published control points and against themselves, systems' texts, regridding between two systems."""

import math

import pytest
from pyspark.sql import functions as F

from rivulet.functions.crs import UnknownSystem, between, parse_text, system_of
from rivulet.model import from_table
from rivulet.operators.grid import Axis, Grid, reproject

FOOT = 0.304800609601219


def projected(ellipsoid, method, parameters, unit="UNIT[\"metre\",1.0]"):
    given = "".join(f',PARAMETER["{k}",{v}]' for k, v in parameters.items())
    return f'PROJCS["p",GEOGCS["g",DATUM["d",SPHEROID["s",{ellipsoid}]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]],PROJECTION["{method}"]{given},{unit}]'


CLARKE, BESSEL, KRASSOWSKI, WGS = "6378206.4,294.9786982", "6377397.155,299.1528128", "6378245.0,298.3", "6378137.0,298.257223563"
#: Control points that the geodesy parameter dataset's guidance publishes: fixed values.
POINTS = {
    "conic, two parallels": (projected(CLARKE, "Lambert_Conformal_Conic_2SP", {"latitude_of_origin": 27 + 50 / 60, "central_meridian": -99, "standard_parallel_1": 28 + 23 / 60, "standard_parallel_2": 30 + 17 / 60, "false_easting": 2000000, "false_northing": 0}, f'UNIT["Foot_US",{FOOT}]'), -96, 28.5, 2963503.91, 254759.80),
    "conic, one parallel": (projected(CLARKE, "Lambert_Conformal_Conic_1SP", {"latitude_of_origin": 18, "central_meridian": -77, "scale_factor": 1, "false_easting": 250000, "false_northing": 150000}), -(76 + 56 / 60 + 37.26 / 3600), 17 + 55 / 60 + 55.80 / 3600, 255966.58, 142493.51),
    "mercator by scale": (projected(BESSEL, "Mercator_1SP", {"central_meridian": 110, "scale_factor": 0.997, "false_easting": 3900000, "false_northing": 900000}), 120, -3, 5009726.58, 569150.82),
    "mercator by parallel": (projected(KRASSOWSKI, "Mercator_2SP", {"standard_parallel_1": 42, "central_meridian": 51}), 53, 53, 165704.29, 5171848.07),
    "polar by scale": (projected(WGS, "Polar_Stereographic", {"latitude_of_origin": 90, "central_meridian": 0, "scale_factor": 0.994, "false_easting": 2000000, "false_northing": 2000000}), 44, 73, 3320416.75, 632668.43),
    "polar by parallel": (projected(WGS, "Polar_Stereographic", {"latitude_of_origin": -71, "central_meridian": 70, "false_easting": 6000000, "false_northing": 6000000}), 120, -75, 7255380.79, 7053389.56),
    "pseudo mercator": (projected(WGS, "Mercator_Auxiliary_Sphere", {"central_meridian": 0}), -(100 + 20 / 60), 24 + 22 / 60 + 54.433 / 3600, -11169055.58, 2800000.00),
}


@pytest.mark.parametrize("name", POINTS)
def test_control_points(spark, name):
    text, lon, lat, east, north = POINTS[name]
    s = system_of(text)
    x, y = s.forward(F.lit(float(lon)), F.lit(float(lat)))
    back = s.inverse(F.lit(east), F.lit(north))
    r = spark.range(1).select(x.alias("x"), y.alias("y"), back[0].alias("lon"), back[1].alias("lat")).first()
    assert abs(r.x - east) < 0.02 and abs(r.y - north) < 0.02
    assert abs(r.lon - lon) < 1e-6 and abs(r.lat - lat) < 1e-6


SPHERE = "6370000.0,0.0"
MODEL = {
    "conic": projected(SPHERE, "Lambert_Conformal_Conic", {"false_easting": 0, "false_northing": 0, "central_meridian": -97, "standard_parallel_1": 30, "standard_parallel_2": 60, "latitude_of_origin": 40.0}),
    "polar": projected(SPHERE, "Stereographic", {"false_easting": 0, "false_northing": 0, "central_meridian": -135, "standard_parallel_1": 60, "latitude_of_origin": 90}),
    "south": projected(WGS, "Stereographic_South_Pole", {"central_meridian": 10, "standard_parallel_1": -60}),
    "conic, south": projected(WGS, "Lambert_Conformal_Conic_2SP", {"central_meridian": 140, "standard_parallel_1": -18, "standard_parallel_2": -36, "latitude_of_origin": -27}),
    "mercator": projected(SPHERE, "Mercator", {"central_meridian": -157.4, "standard_parallel_1": 20.6}),
    "degrees": 'GEOGCS["g",DATUM["d",SPHEROID["s",6370000.0,0.0]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]',
}


@pytest.mark.parametrize("name", MODEL)
def test_there_and_back(spark, name):
    s = system_of(MODEL[name])
    sign = -1 if "south" in name else 1
    points = spark.range(600).select(((F.col("id") % 30) * 11.9 - 179).alias("lon"), (sign * (F.floor(F.col("id") / 30) * 4.2 + 3.3)).alias("lat"))
    x, y = s.forward(F.col("lon"), F.col("lat"))
    there = points.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = s.inverse(F.col("x"), F.col("y"))
    far = there.select(F.abs(lon - F.col("lon")).alias("a"), F.abs(lat - F.col("lat")).alias("b")).agg(F.max("a"), F.max("b")).first()
    assert far[0] < 1e-8 and far[1] < 1e-8


def test_texts():
    assert parse_text('A["x ""y""",B[1,-2.5e1,NORTH]]') == ["A", 'x "y"', ["B", 1.0, -25.0, "NORTH"]]
    for bad in ("", "A[", "A]", "A[}", "A,B", '"x"'):
        with pytest.raises(UnknownSystem):
            parse_text(bad)
    with pytest.raises(UnknownSystem, match="Robinson"):
        system_of(projected(WGS, "Robinson", {}))
    with pytest.raises(UnknownSystem, match="about a pole"):
        system_of(projected(WGS, "Stereographic", {"latitude_of_origin": 50}))
    with pytest.raises(UnknownSystem, match="ellipsoid"):
        system_of('GEOGCS["g",UNIT["Degree",0.017]]')
    new = 'PROJCRS["w",BASEGEOGCRS["b",DATUM["d",ELLIPSOID["e",6378137,298.257223563,LENGTHUNIT["metre",1]]]],CONVERSION["c",METHOD["Lambert Conic Conformal (2SP)"]],CS[Cartesian,2],LENGTHUNIT["metre",1]]'
    with pytest.raises(UnknownSystem, match="Conic Conformal"):
        system_of(new)


def test_regrid_between_systems_without_python(spark):
    cells = spark.range(40 * 30).select((F.col("id") % 40).alias("c"), F.floor(F.col("id") / 40).alias("r"))
    rows = cells.select((F.col("c") * 1.0 - 115).alias("x"), (F.col("r") * 1.0 + 25).alias("y"), (F.col("r") * 100 + F.col("c")).cast("double").alias("v"))
    source = Grid(Axis(-115.0, 1.0, 40), Axis(25.0, 1.0, 30), MODEL["degrees"])
    target = Grid(Axis(-900_000.0, 100_000.0, 20), Axis(-700_000.0, 100_000.0, 15), MODEL["conic"])
    out = reproject(from_table(rows, ("y", "x")), source, target, ["v"])
    assert "Python" not in out.df._jdf.queryExecution().toString() and "Pandas" not in out.df._jdf.queryExecution().toString()
    n = math.log(math.cos(math.radians(30)) / math.cos(math.radians(60))) / math.log(math.tan(math.pi / 4 + math.radians(60) / 2) / math.tan(math.pi / 4 + math.radians(30) / 2))
    f = 6370000 * math.cos(math.radians(30)) * math.tan(math.pi / 4 + math.radians(30) / 2) ** n / n
    rho0 = f / math.tan(math.pi / 4 + math.radians(40) / 2) ** n
    got = {(r.x, r.y): r.v for r in out.df.collect()}
    assert len(got) == 300
    for (x, y), v in got.items():
        rho = math.hypot(x, rho0 - y)
        lat = math.degrees(2 * math.atan((f / rho) ** (1 / n)) - math.pi / 2)
        lon = math.degrees(math.atan2(x, rho0 - y) / n) - 97
        assert v == math.floor(lat + 0.5 - 25) * 100 + math.floor(lon + 115 + 0.5)
    with pytest.raises(ValueError, match="no way between"):
        reproject(from_table(rows, ("y", "x")), source, Grid(target.x, target.y, "EPSG:1"), ["v"])
    assert between(MODEL["conic"], MODEL["degrees"]) is not None
