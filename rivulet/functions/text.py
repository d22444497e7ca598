"""File names, titles and formats as column expressions, with their domains."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The parts of a forecast file's name; a region may name its forecast centre too.
FILE_PATTERN = r"^nwm\.t(\d{2})z\.([a-z0-9_]+?)\.([a-z]+(?:[._][a-z]+)*)(?:_(\d+))?\.(f\d+|tm\d+)\.([a-z]+(?:\.[a-z]{2}rfc)?)\.nc$"
PARTS = ("cycle", "configuration", "output_type", "member", "frame", "region")
#: River forecast centres by code.
CENTERS = {
    "ABRFC": "Arkansas Red-Basin River Forecast Center", "APRFC": "Alaska Pacific River Forecast Center", "CBRFC": "Colorado Basin River Forecast Center", "CNRFC": "California Nevada River Forecast Center", "LMRFC": "Lower Mississippi River Forecast Center",
    "MARFC": "Mid-Atlantic River Forecast Center", "MBRFC": "Missouri Basin River Forecast Center", "NCRFC": "North Central River Forecast Center", "NERFC": "Northeast River Forecast Center", "NWRFC": "Northwest River Forecast Center",
    "OHRFC": "Ohio River Valley River Forecast Center", "SERFC": "Southeast River Forecast Center", "WGRFC": "West Gulf River Forecast Center",
}
#: Words of identifiers that have another form in descriptions, besides the centres' codes.
WORDS = {"extend": "Extended", "conus": "CONUS", "rt": "Routing"}
#: The parts of an output's name, of which date, member and frame may be missing.
OUTPUT_PATTERN = r"^(\w+)\.t(\d{8})?(\d{2})z\.([a-zA-Z_]+)\.(channel_rt|forcing|land|reservoir|)(?:_(\d+))?\.(?:(tm\d+|f\d+)\.)?([a-zA-Z]+)\.(\w+)"
OUTPUT_PARTS = ("model", "date", "cycle", "configuration", "output_type", "member", "frame", "domain", "output_format")
#: Units of sizes in bytes.
SIZES = ("B", "KB", "MB", "GB", "TB", "PB")
#: NetCDF type names by alias, their code, group and width.
NETCDF_TYPES = {
    "float": ("f", "real", 4), "double": ("d", "real", 8), "byte": ("b", "signed", 1), "short": ("s", "signed", 2), "int": ("i", "signed", 4), "int64": ("ll", "signed", 8),
    "ubyte": ("ub", "unsigned", 1), "ushort": ("us", "unsigned", 2), "uint": ("ui", "unsigned", 4), "uint64": ("ull", "unsigned", 8), "char": ("c", "string", 1), "string": ("string", "string", 2),
}
#: The Spark type that holds each NetCDF type; unsigned ones need a wider one.
SPARK_TYPES = {"float": "float", "double": "double", "byte": "tinyint", "short": "smallint", "int": "int", "int64": "bigint", "ubyte": "smallint", "ushort": "int", "uint": "bigint", "uint64": "decimal(20,0)", "char": "string", "string": "string"}
_ALIASES = {"real": "float", "float32": "float", "float64": "double", "int8": "byte", "int16": "short", "int32": "int", "integer": "int", "long": "int64", "uint8": "ubyte", "uint16": "ushort", "uint32": "uint", "str": "string"}


def parse_file_name(name: Column) -> dict[str, Column]:
    """The parts of a file's name; null where a name has no such part or is no such name."""
    return {p: F.nullif(F.regexp_extract(name, FILE_PATTERN, k), F.lit("")) for k, p in enumerate(PARTS, 1)}


def render_file_name(cycle: Column, configuration: Column, output_type: Column, member: Column, lead_s: Column, region: Column) -> Column:
    """The name of a file with these parts; quarter-hourly regions carry minutes in the frame."""
    minutes = F.abs(lead_s) % 3600 / 60
    hours = F.floor(F.abs(lead_s) / 3600)
    ahead = F.when(region == "hawaii", F.format_string("f%03d%02d", hours, minutes.cast("int"))).otherwise(F.format_string("f%03d", hours))
    back = F.when(region == "hawaii", F.format_string("tm%02d%02d", hours, minutes.cast("int"))).otherwise(F.format_string("tm%02d", hours))
    kind = F.when(member.isNull(), output_type).otherwise(F.concat_ws("_", output_type, member))
    return F.format_string("nwm.t%sz.%s.%s.%s.%s.nc", F.lpad(cycle.cast("string"), 2, "0"), configuration, kind, F.when(lead_s < 0, back).otherwise(ahead), region)


def parse_output_name(name: Column) -> dict[str, Column]:
    """The parts of an output's name; null where a name has no such part or is no such name."""
    return {p: F.nullif(F.regexp_extract(name, OUTPUT_PATTERN, k), F.lit("")) for k, p in enumerate(OUTPUT_PARTS, 1)}


def one_of(value: Column, values: list[str]) -> Column:
    """The value if it is one of these, exactly; else null."""
    return F.when(value.isin(*values), value)


def find_one_of(text: Column, values: list[str]) -> Column:
    """The first of these values in a text, the first listed one at a place; null without any."""
    return F.nullif(F.regexp_extract(text, "(" + "|".join(re.escape(v) for v in values) + ")", 1), F.lit(""))


def frame_token(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"(?<=\.)((?:tm|f)\d+)(?=\.)", 1), F.lit(""))


def strip_stage(name: Column) -> Column:
    """Without the stage prefix that intermediate names carry, such as 3.1_."""
    return F.regexp_replace(name, r"^(\d+\.)*\d+_", "")


def named_groups(name: Column, pattern: str) -> dict[str, Column]:
    """Values of the pattern's named groups (?P<n>...)."""
    compiled = re.compile(pattern)
    plain = re.sub(r"\(\?P<", "(?<", pattern)
    return {g: F.nullif(F.regexp_extract(name, plain, k), F.lit("")) for g, k in compiled.groupindex.items()}


def titled(name: Column) -> Column:
    """An identifier as a title: streamFlow_max-value becomes Stream Flow Max Value."""
    spaced = F.regexp_replace(F.regexp_replace(name, r"([a-z0-9])([A-Z])", "$1 $2"), r"[_\-\s]+", " ")
    return F.initcap(F.trim(spaced))


def described(name: Column) -> Column:
    """An identifier as a title, with known words and centres' codes spelled out."""
    known = WORDS | {k.lower(): v for k, v in CENTERS.items()}
    words = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return F.array_join(F.transform(F.split(titled(name), " "), lambda w: F.coalesce(F.try_element_at(words, F.lower(w)), w)), " ")


def center_code(name: Column) -> Column:
    """Code of a centre by its code or full name, whatever the case; null if unknown."""
    pairs = [x for code, full in CENTERS.items() for x in (F.lit(code), F.lit(code), F.lit(full.upper()), F.lit(code))]
    return F.try_element_at(F.create_map(*pairs), F.upper(F.trim(name)))


def center_name(code: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in CENTERS.items() for x in kv]), F.upper(code))


def human_bytes(n: Column) -> Column:
    out = F.format_string("%.2f PB", n / 1000.0**5)
    for k in range(len(SIZES) - 2, -1, -1):
        out = F.when(n < 1000 ** (k + 1), F.format_string(f"%.2f {SIZES[k]}", n / 1000.0**k)).otherwise(out)
    return out


def format_value(value: Column, kind: str) -> Column:
    """Numbers with thousands separators (two decimals for real ones), dates as text."""
    if kind in ("float", "double"):
        return F.format_number(value, 2)
    if kind in ("int", "long", "bigint"):
        return F.format_number(value, 0)
    return F.date_format(value, "yyyy-MM-dd HH:mm") if kind == "timestamp" else value.cast("string")


def template_variables(template: str) -> list[str]:
    """Names in a template's braces, in order, each once."""
    return list(dict.fromkeys(re.findall(r"(?<!\{)\{([A-Za-z_][\w.]*)(?:![rsa])?(?::[^}]*)?\}", template)))


def fill_template(template: str, *scopes: dict) -> str:
    """The template with values from the first scope that has each; ValueError names what none has."""
    values = {}
    for name in template_variables(template):
        found = [s[name] for s in scopes if name in s and s[name] is not None]
        if not found:
            raise ValueError(f"nothing fills '{{{name}}}' in '{template}'")
        values[name] = found[0]
    return re.sub(r"(?<!\{)\{([A-Za-z_][\w.]*)((?:![rsa])?(?::[^}]*)?)\}", lambda m: format(values[m[1]], m[2].lstrip("!rsa").lstrip(":")), template)


def netcdf_type(alias: str) -> str:
    name = alias.strip().lower()
    name = _ALIASES.get(name, name)
    by_code = {v[0]: k for k, v in NETCDF_TYPES.items()}
    name = by_code.get(name, name)
    if name not in NETCDF_TYPES:
        raise KeyError(f"'{alias}' is no NetCDF type")
    return name


def netcdf_type_of(alias: Column) -> Column:
    """The type's name for each row's alias or code; null for what is none."""
    known = {n: n for n in NETCDF_TYPES} | _ALIASES | {v[0]: k for k, v in NETCDF_TYPES.items()}
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), F.lower(F.trim(alias)))


def spark_type_of(netcdf: Column) -> Column:
    """The Spark type that holds each row's NetCDF type."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in SPARK_TYPES.items() for x in kv]), netcdf)


def widest_type(*names: str) -> str:
    """The widest of types of one group; types of different groups can't be compared."""
    types = [netcdf_type(n) for n in names]
    groups = {NETCDF_TYPES[t][1] for t in types}
    if len(groups) != 1:
        raise ValueError(f"types of different groups: {', '.join(sorted(groups))}")
    return max(types, key=lambda t: NETCDF_TYPES[t][2])


def literal_type(text: Column) -> Column:
    """The type that a header's literal has: int, int64, double, float or char."""
    bare = F.trim(text)
    whole = bare.try_cast("decimal(38,0)")
    return (
        F.when(bare.rlike(r'^".*"$'), "char")
        .when(bare.rlike(r"^-?\d+(LL|ll)$"), "int64")
        .when(bare.rlike(r"^-?\d+$") & F.abs(whole).between(0, 2**31 - 1), "int")
        .when(bare.rlike(r"^-?\d+$"), "int64")
        .when(bare.rlike(r"^-?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?[fF]$"), "float")
        .when(bare.rlike(r"^-?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), "double")
        .otherwise("char")
    )
