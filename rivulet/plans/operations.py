"""Operations of a profile: declared fields, checks before anything runs, and what each does to datasets.

A profile is an ordered tree of operations over files. Here a list of files is one dataset whose rows know their file,
so operations on each file are row-wise or keyed by the file, and the whole tree becomes one DataFrame plan for each
sink; Catalyst does the rest.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import MISSING, dataclass, field, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.calendar import parse_duration
from rivulet.functions.text import fill_template
from rivulet.model import Dataset
from rivulet.operators import alignment, aggregates, grid, masks, projections
from rivulet.sources import netcdf, scan, sinks

log = logging.getLogger(__name__)
REGISTRY: dict[str, type[Operation]] = {}
#: Operation names that profiles may declare but nothing implements.
DECLARED_ONLY = ("write", "not_implemented")


class PlanError(ValueError):
    """A profile that can't be run, found before it runs."""


@dataclass
class Context:
    """What operations need besides data: named tables, template values, functions by name, and where outputs went."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    values: dict[str, object] = field(default_factory=dict)
    functions: dict[str, Callable] = field(default_factory=dict)
    grids: dict[str, grid.Grid] = field(default_factory=dict)
    output: str = "."
    saved: list[str] = field(default_factory=list)
    messages: list[str] = field(default_factory=list)
    kept: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        """Lets go of what operations have kept for others."""
        while self.kept:
            self.kept.pop().unpersist()

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise PlanError(f"no table {name}; there are {', '.join(scan.similar_names(name, list(self.tables))) or 'none'}")
        return self.tables[name]

    def fill(self, template: str, data: Dataset | None = None) -> str:
        return fill_template(template, self.values, *((data.metadata, data.attrs) if data else ()))


def register(name: str):
    def add(cls: type[Operation]) -> type[Operation]:
        if name in REGISTRY:
            raise KeyError(f"two operations are called {name}")
        cls.name = name
        REGISTRY[name] = cls
        return cls

    return add


@dataclass(kw_only=True)
class Operation:
    """Base: ``comment``, ``operation_id`` and ``disable`` are common to all."""

    name = ""
    comment: str = ""
    operation_id: str = ""
    disable: bool = False

    def children(self) -> list[Operation]:
        return []

    def walk(self) -> Iterator[Operation]:
        yield self
        for c in self.children():
            yield from c.walk()

    def assign_ids(self, own: str) -> None:
        self.operation_id = self.operation_id or own
        for k, c in enumerate(self.children(), 1):
            c.assign_ids(f"{self.operation_id}.{k}")

    def check(self) -> None:
        """PlanError for fields that make no sense together."""

    def apply(self, data: Dataset, context: Context) -> Dataset:
        raise NotImplementedError

    def summary(self, depth: int = 0) -> str:
        line = "  " * depth + f"{self.operation_id} {self.name}" + (" (disabled)" if self.disable else "")
        return "\n".join([line, *[c.summary(depth + 1) for c in self.children()]])


def load_operation(spec: dict) -> Operation:
    """An operation from its JSON form; unknown keys are ignored, missing ones are errors."""
    if isinstance(spec, Operation):
        return spec
    name = spec.get("operation") or spec.get("operation_type") or spec.get("type")
    if name in DECLARED_ONLY:
        raise PlanError(f"nothing implements {name}")
    if name not in REGISTRY:
        raise PlanError(f"no operation {name}; there are {', '.join(sorted(REGISTRY))}")
    cls = REGISTRY[name]
    known = {f.name: f for f in fields(cls)}
    missing = [n for n, f in known.items() if f.default is MISSING and f.default_factory is MISSING and n not in spec]
    if missing:
        raise PlanError(f"{name} lacks {', '.join(missing)}")
    for k in spec.keys() - known.keys() - {"operation", "operation_type", "type"}:
        log.debug("%s has no field %s", name, k)
    op = cls(**{k: v for k, v in spec.items() if k in known})
    op.check()
    return op


def run_all(operations: list[Operation], data: Dataset, context: Context, debug: bool = False, on_complete: list[Callable] | None = None) -> Dataset:
    """Each operation on the result of the one before; then the handlers, whose results, if any, replace the data."""
    for op in operations:
        if op.disable:
            if not debug:
                raise PlanError(f"{op.operation_id} {op.name} is disabled")
            continue
        data = op.apply(data, context)
    for handler in on_complete or []:
        new = handler(data)
        data = data if new is None else new
    return data


def _operations(specs: list) -> list[Operation]:
    return [load_operation(s) for s in specs]


@register("load")
@dataclass(kw_only=True)
class Load(Operation):
    """Files are datasets already; with ``persist`` the rows are kept for the operations that follow."""

    load_arguments: dict = field(default_factory=dict)
    persist: bool = False

    def apply(self, data, context):
        if self.persist:
            data = data.pipe(lambda df: df.persist())
            context.kept.append(data.df)
        return data


@register("drop")
@dataclass(kw_only=True)
class Drop(Operation):
    fields: list[str]
    exclude: bool = False
    drop_dimension: bool = False

    def apply(self, data, context):
        return projections.drop_dimensions(data, self.fields) if self.drop_dimension else projections.drop(data, self.fields, self.exclude)


@register("rename")
@dataclass(kw_only=True)
class Rename(Operation):
    mapping: dict[str, str]
    rename_variable: bool = True

    def apply(self, data, context):
        return projections.rename(data, self.mapping) if self.rename_variable else projections.rename_dimensions(data, self.mapping)


@register("attribute")
@dataclass(kw_only=True)
class Attribute(Operation):
    attribute_name: str
    field: str = "global"
    attribute_value: object = None
    attribute_type: str = "string"
    mode: str = "overwrite"

    def check(self):
        if self.mode.lower() not in projections.MODES and self.mode not in projections.MODES.values():
            raise PlanError(f"attribute has no mode {self.mode}")

    def apply(self, data, context):
        value = context.fill(self.attribute_value, data) if isinstance(self.attribute_value, str) else self.attribute_value
        kind = self.attribute_type.lower()
        if value is not None and kind != "string":
            value = float(value) if kind in ("float", "double") else int(value)
        return projections.attribute(data, self.attribute_name, value, self.field, self.mode)


@register("unit_conversion")
@dataclass(kw_only=True)
class UnitConversion(Operation):
    conversions: list[dict]
    compat: bool = False

    def apply(self, data, context):
        return projections.unit_conversion(data, self.conversions, self.compat)


@register("total_over_time")
@dataclass(kw_only=True)
class TotalOverTime(Operation):
    rate_variable_name: str
    total_variable_name: str
    output_unit: str | None = None
    input_quantity_unit: str | None = None
    input_time_unit: str = "seconds"
    time_unit: str = "hours"
    amount_of_time: float = 1
    total_variable_attributes: dict = field(default_factory=dict)

    def apply(self, data, context):
        return projections.total_over_time(data, self.rate_variable_name, self.total_variable_name, self.amount_of_time, self.time_unit, self.input_time_unit, self.output_unit, self.input_quantity_unit, self.total_variable_attributes)


@register("calculate_time_bound")
@dataclass(kw_only=True)
class TimeBound(Operation):
    time_variable: str = "time"
    time_unit: str = "hours"
    amount_of_time: float = 1
    output_name: str = "time_bounds"
    bound_dimension_name: str = "nv"
    time_bound_attributes: dict = field(default_factory=dict)

    def apply(self, data, context):
        out = aggregates.time_bounds(data, self.time_variable, self.amount_of_time, self.time_unit, self.output_name, self.bound_dimension_name)
        return replace(out, var_attrs={**out.var_attrs, self.output_name: dict(self.time_bound_attributes)})


@register("adjust_dimensions")
@dataclass(kw_only=True)
class AdjustDimensions(Operation):
    mapping: dict[str, list[str]]

    def apply(self, data, context):
        return projections.adjust_dimensions(data, self.mapping)


@register("combine")
@dataclass(kw_only=True)
class Combine(Operation):
    variables: list[str]
    name: str
    new_dimension: str
    attributes: dict = field(default_factory=dict)
    encoding: dict = field(default_factory=dict)

    def apply(self, data, context):
        return projections.combine(data, self.variables, self.name, self.new_dimension, self.attributes, self.encoding)

    def summary(self, depth=0):
        return "  " * depth + f"{self.operation_id} combine"


@register("expression")
@dataclass(kw_only=True)
class Expression(Operation):
    """Variables from SQL expressions over the others."""

    expressions: dict[str, str]
    attributes: dict[str, dict] = field(default_factory=dict)

    def apply(self, data, context):
        return projections.compute(data, self.expressions, self.attributes)


@register("merge")
@dataclass(kw_only=True)
class Merge(Operation):
    """All files as one: the rows are together already, so only the key that parts them goes; ``collapse`` names
    variables that become scalars if they have one value, and ``narrow`` puts double variables in single precision.

    ``by_coordinates`` aligns files cell by cell instead, each cell once; files must follow each other ``along`` a dimension,
    if one is named, and ``conflicts`` says what becomes of values that disagree."""

    collapse: list[str] = field(default_factory=list)
    narrow: bool = False
    by_coordinates: bool = False
    along: str | None = None
    conflicts: str = "raise"

    def apply(self, data, context):
        data = projections.narrow(data) if self.narrow else data
        if self.by_coordinates:
            data = alignment.align(data, self.along, self.conflicts)
        whole = replace(data, df=data.df.drop(*[c for c in data.file_key if c not in data.dims]), file_key=())
        return projections.uniform_collapse(whole, self.collapse) if self.collapse else whole


@register("group_by")
@dataclass(kw_only=True)
class GroupByLead(Operation):
    """Cuts files into consecutive lead buckets and runs ``on_each`` in each: operations see the bucket as their file."""

    on_each: list
    time_unit: str = "hours"
    amount_of_time: float = 1.0
    period: str = "PT1H"
    include_time_bounds: bool = False
    time_bound_name: str = "time_bounds"
    time_variable_name: str = "time"
    lead_variable_name: str = "lead_seconds"

    def check(self):
        self.on_each = _operations(self.on_each)

    def children(self):
        return self.on_each

    def apply(self, data, context):
        data.need(self.lead_variable_name)
        seconds = self.amount_of_time * {"seconds": 1, "minutes": 60, "hours": 3600, "days": 86400}[self.time_unit.lower()]
        placed = data.df.withColumn("bucket", aggregates.lead_bucket(F.col(self.lead_variable_name), seconds))
        about = [F.max(self.lead_variable_name).alias("last")]
        if self.include_time_bounds:
            step = F.make_dt_interval(secs=F.lit(parse_duration(self.period).total_seconds()))
            about.append(F.array(F.min(self.time_variable_name) - step, F.max(self.time_variable_name)).alias(self.time_bound_name))
        small = placed.groupBy("bucket").agg(*about)
        named = small.withColumn("group", aggregates.bucket_name(F.col("last"), seconds)).drop("last")
        keys = ("group", *([self.time_bound_name] if self.include_time_bounds else []))
        grouped = replace(data, df=placed.join(named, "bucket").drop("bucket"), file_key=keys)
        return run_all(self.on_each, grouped, context)


@register("stream")
@dataclass(kw_only=True)
class Stream(Operation):
    """Folds variables over the files of a group, cell by cell."""

    operations: list[dict]

    def check(self):
        unknown = [o["operation"] for o in self.operations if o["operation"] not in aggregates.FOLDS]
        if unknown:
            raise PlanError(f"stream has no operation {', '.join(unknown)}")

    def apply(self, data, context):
        keys = [*[k for k in data.file_key if k != "file"], *[d for d in data.dims if d not in ("time", *data.file_key)]]
        return aggregates.stream_fold(data, self.operations, keys)


@register("anomaly")
@dataclass(kw_only=True)
class Anomaly(Operation):
    variable_name: str
    thresholds: list[dict]
    default_score: float
    table: str = "thresholds"
    on: list[str] = field(default_factory=lambda: ["feature_id", "day"])
    output_variable_name: str = "streamflow_anomaly"

    def check(self):
        levels = [t["level"] for t in self.thresholds]
        if len(set(levels)) != len(levels):
            raise PlanError("anomaly has a level twice")

    def apply(self, data, context):
        levels = {t["variable"]: t["level"] for t in self.thresholds}
        return masks.anomaly(data, self.variable_name, context.table(self.table), levels, self.default_score, self.on, self.output_variable_name)


@register("reproject")
@dataclass(kw_only=True)
class Reproject(Operation):
    reference_dataset_path: str
    source_grid: str = "source"
    variables: list[str] = field(default_factory=list)
    x_variable: str = "x"
    y_variable: str = "y"
    by: list[str] = field(default_factory=list)

    def apply(self, data, context):
        source = context.grids.get(self.source_grid) or grid.grid_of(data.df, self.x_variable, self.y_variable)
        if self.reference_dataset_path not in context.grids:
            raise PlanError(f"no grid {self.reference_dataset_path}")
        target = context.grids[self.reference_dataset_path]
        return grid.reproject(data, source, target, self.variables or data.variables, self.x_variable, self.y_variable, self.by, context.functions.get("reproject_points"))


@dataclass(kw_only=True)
class _Masked(Operation):
    masks: list[str]
    each: list = field(default_factory=list)
    identifier_pattern: str = ""
    output_pattern: str = ""

    def check(self):
        self.each = _operations(self.each)

    def children(self):
        return self.each


@register("extract")
@dataclass(kw_only=True)
class Extract(_Masked):
    """Rows by id masks, all masks in one join; the masks' identifier columns become the files' key."""

    dimension: str = "feature_id"
    mask_coordinate: str = ""
    identifiers: list[str] = field(default_factory=list)

    def apply(self, data, context):
        data.need(self.dimension)
        mask = context.table(self.masks[0])
        for other in self.masks[1:]:
            mask = mask.unionByName(context.table(other))
        df = masks.extract(data.df, mask, self.dimension, self.mask_coordinate or None, self.identifiers)
        return run_all(self.each, replace(data, df=df, file_key=(*data.file_key, *[i for i in self.identifiers if i not in data.file_key])), context)


@register("subset")
@dataclass(kw_only=True)
class Subset(_Masked):
    """Nulls outside a grid mask; several masks give the union of their outputs, told apart by ``mask``."""

    mask_variable: str = "keep"
    mask_coordinates: list[str] = field(default_factory=lambda: ["y", "x"])

    def apply(self, data, context):
        outs = [replace(o := masks.subset(data, context.table(m), self.mask_coordinates, self.mask_variable), df=o.df.withColumn("mask", F.lit(m)), file_key=(*data.file_key, "mask")) for m in self.masks]
        whole = outs[0]
        for o in outs[1:]:
            whole = whole.with_df(whole.df.unionByName(o.df))
        return run_all(self.each, whole, context)


@register("file_filter")
@dataclass(kw_only=True)
class FileFilter(Operation):
    """Keeps files by conditions on their names' parts."""

    on: dict

    def check(self):
        todo = [self.on]
        while todo:
            s = todo.pop()
            if "and" in s or "or" in s:
                todo += s.get("and", s.get("or"))
            elif s.get("operator") not in masks.OPERATORS:
                raise PlanError(f"file_filter has no operator {s.get('operator')}")

    def apply(self, data, context):
        return data.pipe(lambda df: df.where(masks.condition(self.on)))


@register("branch")
@dataclass(kw_only=True)
class Branch(Operation):
    """Every branch gets the same data; the result is all their rows, told apart by ``branch``. With ``persist`` the data
    are kept until ``Context.release``, to be called when the sinks have run."""

    branches: dict[str, list]
    persist: bool = False

    def check(self):
        if not self.branches:
            raise PlanError("branch has no branches")
        self.branches = {k: _operations(v) for k, v in self.branches.items()}

    def children(self):
        return [o for ops in self.branches.values() for o in ops]

    def apply(self, data, context):
        shared = data
        if self.persist and len(self.branches) > 1:
            shared = data.pipe(lambda df: df.persist())
            context.kept.append(shared.df)
        outs = []
        for name, ops in self.branches.items():
            inner = replace(context, values={**context.values, "branch": name}, saved=context.saved)
            o = run_all(ops, shared, inner)
            outs.append(replace(o, df=o.df.withColumn("branch", F.lit(name))))
        context.saved[:] = dict.fromkeys(context.saved)  # branches may have written the same outputs; the first place counts
        whole = outs[0]
        for o in outs[1:]:
            whole = replace(whole, df=whole.df.unionByName(o.df, allowMissingColumns=True))
        return replace(whole, file_key=(*whole.file_key, "branch"))


@register("on_each")
@dataclass(kw_only=True)
class OnEach(Operation):
    """Operations for each file: rows know their file, so the sub-operations apply to all files at once."""

    on_each: list
    thread_count: int | None = None

    def check(self):
        self.on_each = _operations(self.on_each)

    def children(self):
        return self.on_each

    def apply(self, data, context):
        return run_all(self.on_each, data, context)


@register("function")
@dataclass(kw_only=True)
class Function(Operation):
    """Calls a registered function by its name; nothing is imported. A None result hands the data on."""

    function: str
    kwargs: dict = field(default_factory=dict)
    argument_mapping: dict[str, str] = field(default_factory=dict)

    def apply(self, data, context):
        known = BUILT_IN | context.functions
        if self.function not in known:
            raise PlanError(f"no function {self.function}; there are {', '.join(sorted(known))}")
        kwargs = {k: context.fill(v, data) if isinstance(v, str) else v for k, v in self.kwargs.items()}
        for argument, what in self.argument_mapping.items():
            kwargs[argument] = {"data": data, "metadata": data.metadata, "settings": context.values}.get(what, context.tables.get(what))
        out = known[self.function](context=context, **kwargs) if "data" in self.argument_mapping.values() else known[self.function](data, context=context, **kwargs)
        return data if out is None else out


@register("echo")
@dataclass(kw_only=True)
class Echo(Operation):
    message: str
    level: str = "INFO"
    verbosity: str = "NORMAL"
    logger_name: str = __name__

    def apply(self, data, context):
        text = context.fill(self.message, data)
        context.messages.append(text)
        logging.getLogger(self.logger_name).log(logging.getLevelName(self.level.upper()), text)
        return data


@register("raise")
@dataclass(kw_only=True)
class Raise(Operation):
    message: str

    def apply(self, data, context):
        raise RuntimeError(context.fill(self.message, data))


@register("peek")
@dataclass(kw_only=True)
class Peek(Operation):
    show_summary: bool = True
    show_state: bool = True
    show_metadata: bool = True

    def apply(self, data, context):
        text = sinks.peek(data, 0) if self.show_summary else ""
        if self.show_metadata:
            text += "\n" + "\n".join(f"{k} = {v}" for k, v in {**data.metadata, **context.values}.items())
        context.messages.append(text)
        log.info(text)
        return data


@register("save")
@dataclass(kw_only=True)
class Save(Operation):
    directory: str
    filename_pattern: str
    return_new_paths: bool = True
    identifier_pattern: str = ""
    include_conditions: dict = field(default_factory=dict)
    pack_values: bool = False
    mode: str = "errorifexists"
    file_format: str = "parquet"

    def apply(self, data, context):
        directory = context.fill(self.directory, data)
        if not directory.startswith("/") and ":" not in directory:
            directory = f"{context.output.rstrip('/')}/{directory}"
        if self.file_format == "netcdf":
            written = netcdf.write_files(data, directory, self.filename_pattern, self.include_conditions or None, self.pack_values, context.values)
            context.saved += [f"{directory.rstrip('/')}/{r['target']}" for r in written.orderBy("target").toLocalIterator()]
            return data
        context.saved += sinks.save(data, directory, self.filename_pattern, context.values, self.include_conditions or None, self.pack_values, self.mode)
        return data


def _upstream(data: Dataset, context: Context, table: str = "routelink", variable: str = "streamflow", output: str = "upstream_flow", feature: str = "feature_id", link: str = "link", to: str = "to", by: list[str] | None = None) -> Dataset:
    data.need(variable, feature)
    by = by if by is not None else [*[k for k in data.file_key if k in data.df.columns], *(["time"] if "time" in data.df.columns else [])]
    return data.with_df(masks.upstream_sum(data.df, context.table(table), variable, output, feature, link, to, list(dict.fromkeys(by))))


def _clean(data: Dataset, context: Context, **_) -> None:
    for t in context.tables.values():
        t.unpersist()


BUILT_IN: dict[str, Callable] = {"calculate_upstream_flow_binned": _upstream, "clean": _clean}
