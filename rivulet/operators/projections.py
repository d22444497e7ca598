"""Operators that change columns, dimensions and attributes: narrow, row by row, no shuffle unless said."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import titled
from rivulet.functions.units import find_conversion, time_multiplier
from rivulet.model import Dataset, MissingVariable

log = logging.getLogger(__name__)

MODES = {"append": "a", "create": "c", "delete": "d", "modify": "m", "append_if_exists": "n", "overwrite": "o", "prepend": "p"}


def drop(data: Dataset, fields: list[str], exclude: bool = False) -> Dataset:
    """Without the named variables, or with them alone; names that aren't there are passed over."""
    gone = [c for c in data.df.columns if (c in fields) != exclude and c not in data.file_key]
    keep = lambda d: {k: v for k, v in d.items() if k not in gone and (not exclude or k in fields or k in data.file_key)}
    scalars = {k: v for k, v in data.scalars.items() if (k in fields) == exclude}
    return data.with_df(data.df.drop(*gone), dims=tuple(d for d in data.dims if d not in gone), coords=tuple(c for c in data.coords if c not in gone), var_attrs=keep(data.var_attrs), encoding=keep(data.encoding), var_dims=keep(data.var_dims), scalars=scalars)


def drop_dimensions(data: Dataset, fields: list[str]) -> Dataset:
    """Without the dimensions and every variable over them; what is left has one row a remaining cell (a shuffle)."""
    gone = [c for c in data.df.columns if c in fields or set(data.dims_of(c)) & set(fields)]
    out = drop(data, gone)
    return out.pipe(lambda df: df.distinct()) if gone and out.df.columns else out


def rename(data: Dataset, mapping: dict[str, str]) -> Dataset:
    """Variables under new names; global attributes whose value is an old name follow."""
    data.need(*mapping)
    clash = [n for n in mapping.values() if n in data.df.columns and n not in mapping]
    if clash:
        raise ValueError(f"already there: {', '.join(clash)}")
    new = lambda n: mapping.get(n, n)
    keys = lambda d: {new(k): v for k, v in d.items()}
    attrs = {k: mapping.get(v, v) if isinstance(v, str) else v for k, v in data.attrs.items()}
    return replace(
        data, df=data.df.withColumnsRenamed(mapping), attrs=attrs, var_attrs=keys(data.var_attrs), encoding=keys(data.encoding), scalars=keys(data.scalars),
        dims=tuple(map(new, data.dims)), coords=tuple(map(new, data.coords)), file_key=tuple(map(new, data.file_key)), var_dims={new(k): tuple(map(new, v)) for k, v in data.var_dims.items()},
    )


def rename_dimensions(data: Dataset, mapping: dict[str, str]) -> Dataset:
    missing = [d for d in mapping if d not in data.dims]
    if missing:
        raise MissingVariable(f"no dimension {', '.join(missing)}")
    return rename(data, mapping)


def edit_attribute(attrs: dict[str, object], name: str, value: object, mode: str) -> dict[str, object]:
    """The seven ways to edit an attribute: strings are joined, other values become lists."""
    code = MODES.get(mode.lower(), mode)
    out, there = dict(attrs), name in attrs
    joined = lambda a, b: a + b if isinstance(a, str) and isinstance(b, str) else [*(a if isinstance(a, list) else [a]), *(b if isinstance(b, list) else [b])]
    if code == "d":
        out.pop(name, None)
    elif code == "o" or (code == "c" and not there) or (code == "m" and there) or (code in "ap" and not there):
        out[name] = value
    elif code in ("a", "n") and there:
        out[name] = joined(out[name], value)
    elif code == "p" and there:
        out[name] = joined(value, out[name])
    elif code not in "acdmnop":
        raise ValueError(f"no such mode: {mode}")
    return out


def attribute(data: Dataset, name: str, value: object = None, variable: str = "global", mode: str = "overwrite") -> Dataset:
    if variable == "global":
        return replace(data, attrs=edit_attribute(data.attrs, name, value, mode))
    data.need(variable)
    return replace(data, var_attrs={**data.var_attrs, variable: edit_attribute(data.var_attrs.get(variable, {}), name, value, mode)})


def attribute_map(attrs: Column, name: str, value: str, mode: str) -> Column:
    """The same edits on a map column, one map a row."""
    code, there = MODES.get(mode.lower(), mode), F.map_contains_key(attrs, F.lit(name))
    without = F.map_filter(attrs, lambda k, _: k != name)
    with_ = lambda v: F.map_concat(without, F.create_map(F.lit(name), v))
    old, new = F.try_element_at(attrs, F.lit(name)), F.lit(value)
    return {
        "o": lambda: with_(new),
        "c": lambda: F.when(there, attrs).otherwise(with_(new)),
        "m": lambda: F.when(there, with_(new)).otherwise(attrs),
        "d": lambda: without,
        "a": lambda: with_(F.when(there, F.concat(old, new)).otherwise(new)),
        "n": lambda: F.when(there, with_(F.concat(old, new))).otherwise(attrs),
        "p": lambda: with_(F.when(there, F.concat(new, old)).otherwise(new)),
    }[code]()


def adjust_dimensions(data: Dataset, mapping: dict[str, list[str]]) -> Dataset:
    """Adds missing dimensions to variables, in the given places; never takes one away or reorders."""
    var_dims = dict(data.var_dims)
    for name, wanted in mapping.items():
        if name not in data.df.columns and name not in data.scalars:
            log.warning("no variable %s to adjust", name)
            continue
        unknown = [d for d in wanted if d not in data.dims]
        if unknown:
            raise MissingVariable(f"no dimension {', '.join(unknown)}")
        dims = list(data.dims_of(name)) if name in data.df.columns else []
        for at, d in enumerate(wanted):
            if d not in dims:
                dims.insert(min(at, len(dims)), d)
        var_dims[name] = tuple(dims)
    spread = {n: F.lit(data.scalars[n]) for n in mapping if n in data.scalars and n not in data.df.columns}
    out = data.with_columns(spread) if spread else data
    return replace(out, var_dims=var_dims, scalars={k: v for k, v in data.scalars.items() if k not in spread})


def combine(data: Dataset, variables: list[str], name: str, new_dimension: str, attributes: dict | None = None, encoding: dict | None = None) -> Dataset:
    """Stacks variables of one shape into an array column along a new last dimension."""
    data.need(*variables)
    shapes = {data.dims_of(v) for v in variables}
    kinds = {dict(data.df.dtypes)[v] for v in variables}
    if len(shapes) > 1:
        raise ValueError(f"different dimensions: {sorted(shapes)}")
    if len(kinds) > 1 and not kinds <= {"float", "double", "int", "bigint", "smallint", "tinyint"}:
        raise ValueError(f"different types: {sorted(kinds)}")
    out = data.with_columns({name: F.array(*[F.col(v) for v in variables])}, {name: dict(attributes or {})})
    return replace(out, var_dims={**out.var_dims, name: (*shapes.pop(), new_dimension)}, encoding={**out.encoding, name: dict(encoding or {})})


def unit_conversion(data: Dataset, conversions: list[dict], compat: bool = False) -> Dataset:
    """Converts variables from their units (encoding first, then attributes) to the wanted ones."""
    columns, attrs, encoding = {}, dict(data.var_attrs), dict(data.encoding)
    for c in conversions:
        name, target = c["variable_name"], c["target_unit"]
        data.need(name)
        source = data.encoding.get(name, {}).get("units") or data.var_attrs.get(name, {}).get("units")
        if source is None:
            raise ValueError(f"{name} has no units")
        columns[name] = find_conversion(str(source), target, compat)(F.col(name))
        attrs[name] = {**attrs.get(name, {}), "units": target}
        if "units" in encoding.get(name, {}):
            encoding[name] = {**encoding[name], "units": target}
    return replace(data.with_columns(columns), var_attrs=attrs, encoding=encoding)


def total_over_time(data: Dataset, rate: str, total: str, amount: float = 1.0, unit: str = "hours", per: str = "seconds", output_unit: str | None = None, quantity_unit: str | None = None, attributes: dict | None = None, compat: bool = False) -> Dataset:
    """A new variable: the rate over a period, in single precision."""
    data.need(rate)
    if rate in data.dims or rate in data.coords:
        raise MissingVariable(f"{rate} is a coordinate")
    value = F.col(rate).cast("double") * F.lit(time_multiplier(amount, unit, per))
    old = data.var_attrs.get(rate, {})
    attrs = {k: f"Accumulated {v}" if "name" in k else v for k, v in old.items()} | {"cell_methods": "time: sum"}
    if quantity_unit:
        attrs["units"] = quantity_unit
    if output_unit:
        value = find_conversion(str(attrs.get("units", "")), output_unit, compat)(value)
        attrs["units"] = output_unit
    return data.with_columns({total: value.cast("float")}, {total: attrs | dict(attributes or {})})


def compute(data: Dataset, expressions: dict[str, str], attributes: dict[str, dict] | None = None) -> Dataset:
    """Variables from SQL expressions over the others, one after the other, so later ones see earlier ones."""
    out = data
    for name, text in expressions.items():
        if name in data.dims or name in data.coords:
            raise ValueError(f"{name} is a coordinate")
        out = out.with_columns({name: F.expr(text)}, {name: {**out.var_attrs.get(name, {}), **(attributes or {}).get(name, {})}})
    return out


def narrow(data: Dataset) -> Dataset:
    """Double-precision variables in single precision; dimensions and coordinates stay."""
    wide = [n for n, t in data.df.dtypes if t == "double" and n in data.variables]
    return data.with_columns({n: F.col(n).cast("float") for n in wide}) if wide else data


def flatten_values(df: DataFrame, column: str, unique: bool = False, where: Callable[[Column], Column] | None = None) -> DataFrame:
    """An array of arrays as one array, one level less deep; maybe each value once, or those alone that pass a test."""
    values = F.flatten(F.col(column))
    values = F.filter(values, where) if where is not None else values
    return df.withColumn(column, F.array_distinct(values) if unique else values)


def uniform_collapse(data: Dataset, variables: list[str]) -> Dataset:
    """Variables with one value everywhere (or none) become scalars. One aggregate pass over the data."""
    data.need(*variables)
    asked = [x for v in variables for x in (F.min(v).alias(f"{v}__min"), F.max(v).alias(f"{v}__max"), F.count(v).alias(f"{v}__n"))]
    row = data.df.agg(F.count(F.lit(1)).alias("__all"), *asked).first().asDict()
    same = [v for v in variables if row[f"{v}__n"] == 0 or (row[f"{v}__min"] == row[f"{v}__max"] and row[f"{v}__n"] == row["__all"])]
    out = replace(data, scalars={**data.scalars, **{v: row[f"{v}__min"] for v in same}})
    return out.with_df(out.df.drop(*same))


def reorder(data: Dataset, order: list[str]) -> Dataset:
    if sorted(order) != sorted(data.dims):
        raise MissingVariable(f"dimensions are {', '.join(data.dims)}")
    rest = [c for c in data.df.columns if c not in order]
    return data.with_df(data.df.select(*order, *rest), dims=tuple(order))


def derived_name(name: str, suffix: str) -> str:
    """Title of a derived variable, as the attributes have it."""
    words = name.replace("-", "_").split("_")
    return " ".join(w.capitalize() for w in [*words, suffix])


__all__ = ["adjust_dimensions", "attribute", "attribute_map", "combine", "compute", "flatten_values", "narrow", "derived_name", "drop", "drop_dimensions", "edit_attribute", "rename", "rename_dimensions", "reorder", "titled", "total_over_time", "uniform_collapse", "unit_conversion"]
