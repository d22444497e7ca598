"""The data model: labelled variables over dimensions as a tidy table, with attributes beside it.

One row is one cell (a combination of dimension values), one column a variable over all of them. Scalars, attributes
and encodings live in plain dictionaries on the driver, since Spark drops column metadata with any expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MissingVariable(KeyError):
    """A named variable or dimension isn't there."""


@dataclass(frozen=True)
class Dataset:
    """Cells of one or many files. ``file_key`` names the columns that tell files apart."""

    df: DataFrame
    dims: tuple[str, ...] = ()
    coords: tuple[str, ...] = ()
    file_key: tuple[str, ...] = ()
    attrs: dict[str, object] = field(default_factory=dict)
    var_attrs: dict[str, dict[str, object]] = field(default_factory=dict)
    encoding: dict[str, dict[str, object]] = field(default_factory=dict)
    var_dims: dict[str, tuple[str, ...]] = field(default_factory=dict)
    scalars: dict[str, object] = field(default_factory=dict)
    metadata: dict[str, object] = field(default_factory=dict)

    @property
    def variables(self) -> list[str]:
        held = {*self.dims, *self.coords, *self.file_key}
        return [c for c in self.df.columns if c not in held]

    def dims_of(self, name: str) -> tuple[str, ...]:
        return self.var_dims.get(name, (name,) if name in self.dims else self.dims)

    def need(self, *names: str) -> None:
        """MissingVariable, before anything runs, unless all are there."""
        gone = [n for n in names if n not in self.df.columns and n not in self.scalars]
        if gone:
            raise MissingVariable(f"no {', '.join(gone)} among {', '.join(self.df.columns)}")

    def with_df(self, df: DataFrame, **changes) -> Dataset:
        return replace(self, df=df, **changes)

    def with_columns(self, columns: dict[str, Column], attrs: dict[str, dict] | None = None) -> Dataset:
        return self.with_df(self.df.withColumns(columns), var_attrs={**self.var_attrs, **(attrs or {})})

    def pipe(self, f: Callable[[DataFrame], DataFrame]) -> Dataset:
        return self.with_df(f(self.df))

    def describe(self) -> str:
        """One line for each variable: name(dimensions): type [units]."""
        out = [f"dimensions: {', '.join(self.dims) or '-'}"]
        for name, kind in self.df.dtypes:
            unit = self.var_attrs.get(name, {}).get("units")
            out.append(f"{name}({', '.join(self.dims_of(name))}): {kind}" + (f" [{unit}]" if unit else ""))
        out += [f"{k} = {v}" for k, v in self.scalars.items()]
        out += [f":{k} = {v}" for k, v in self.attrs.items()]
        return "\n".join(out)


def from_table(df: DataFrame, dims: Iterable[str], coords: Iterable[str] = (), file_key: Iterable[str] = (), **more) -> Dataset:
    """A dataset over a table, with NaN turned to null: aggregates and comparisons skip what is missing."""
    real = [c for c, t in df.dtypes if t in ("float", "double")]
    clean = df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in real}) if real else df
    return Dataset(clean, tuple(dims), tuple(coords), tuple(file_key), **more)
