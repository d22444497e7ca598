"""Forecast files in the classic NetCDF format, as a Spark data source named ``netcdf``: read and written in parallel.

Reading: a file's header says where each variable's values lie. Only the asked variables (which share their dimensions)
are read, and only slabs of at most ``slab_bytes``, one a partition. Comparisons of a dimension with a constant are pushed
down: the dimension's coordinate is read alone, and slabs shrink to the range of places that can agree, or go. Spark still
tests each row. One row is one cell: the dimensions' coordinates (or places, where there is none), then the variables.

Planning reads one header a file on the driver, some kilobytes; with ``same_layout`` the first file's header stands for all
(tasks compare theirs and refuse another one), and each file's coordinates are looked at in the tasks.

Writing: one file a target, named by the column ``target``. Tasks write ``<target>.incomplete``; when all have ended the
driver renames them, or removes them all. A target that exists, or that two tasks have, stops the write before any
rename. A target's rows must meet in one task, in the order of their dimensions (``write_files`` deals them so): it spools them
on its own disk and holds a batch, and the values of all dimensions but the first. Rows in another order are held whole.

Values: missing ones are null, packed ones are scaled, times are timestamps, texts are character arrays with one more
dimension, as the conventions of these files say (``decode=false`` gives stored values). Paths may be of any file system that
Arrow opens.
"""

from __future__ import annotations

import posixpath
import re
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from rivulet.functions.text import fill_template, template_variables
from rivulet.model import Dataset, from_table
from rivulet.operators.grid import CRS_NAMES, EVEN, WKT_NAMES, X_NAMES, Y_NAMES, Axis, Grid, mask_cells
from rivulet.operators.masks import include_conditions
from rivulet.sources.sinks import default_encoding, duplicate_targets, packed, save_targets, target_name

#: The format's type codes, as big-endian numpy types; 2 holds characters.
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: "u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
CODES = {np.dtype(t): c for c, t in TYPES.items()}
#: Tags of the header's lists.
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12
#: The Spark type of decoded values by type code; unsigned ones need a wider one.
SPARK_TYPES = {1: "tinyint", 2: "string", 3: "smallint", 4: "int", 5: "float", 6: "double", 7: "smallint", 8: "int", 9: "bigint", 10: "bigint", 11: "decimal(20,0)"}
#: Seconds in a unit of time.
TIME_UNITS = {"microseconds": 1e-6, "milliseconds": 1e-3, "seconds": 1, "minutes": 60, "hours": 3600, "days": 86400}
SLAB_BYTES = 16 << 20
BATCH_ROWS = 1 << 16
SINCE = re.compile(r"^\s*(\w+?)s?\s+since\s+(\d{4}-\d{1,2}-\d{1,2})(?:[T ](\d{1,2}:\d{2}(?::\d{2})?))?", re.I)


class FormatError(ValueError):
    """Bytes that are no classic NetCDF file, or not the one expected."""


@dataclass
class Variable:
    name: str
    dims: tuple[str, ...]
    shape: tuple[int, ...]
    code: int
    begin: int
    record: bool = False
    attrs: dict[str, object] = field(default_factory=dict)

    @property
    def dtype(self) -> np.dtype:
        return np.dtype(TYPES[self.code])

    @property
    def text_length(self) -> int:
        """Characters of each text, the last dimension of a character array; 0 for other variables."""
        return self.shape[-1] if self.code == 2 and self.shape else 0

    @property
    def cell_dims(self) -> tuple[str, ...]:
        return self.dims[:-1] if self.text_length else self.dims

    @property
    def is_time(self) -> bool:
        return self.code != 2 and bool(SINCE.match(str(self.attrs.get("units", ""))))


@dataclass
class Header:
    version: int
    dims: dict[str, int]
    attrs: dict[str, object]
    variables: dict[str, Variable]
    record_bytes: int

    def layout(self) -> str:
        return repr((self.dims, self.record_bytes, [(v.name, v.dims, v.code, v.begin) for v in self.variables.values()]))


def _padded(n: int) -> int:
    return (n + 3) // 4 * 4


class _Cursor:
    """Numbers and names of a header, read in order."""

    def __init__(self, file) -> None:
        self.file, self.version = file, 1

    def take(self, n: int) -> bytes:
        data = self.file.read(n)
        if len(data) < n:
            raise FormatError("the header ends early")
        return data

    def number(self) -> int:
        return struct.unpack(">q", self.take(8))[0] if self.version == 5 else struct.unpack(">i", self.take(4))[0]

    def tag(self) -> tuple[int, int]:
        kind = struct.unpack(">i", self.take(4))[0]
        return kind, self.number()

    def offset(self) -> int:
        return struct.unpack(">i", self.take(4))[0] if self.version == 1 else struct.unpack(">q", self.take(8))[0]

    def name(self) -> str:
        n = self.number()
        return self.take(_padded(n))[:n].decode()

    def values(self) -> object:
        code = struct.unpack(">i", self.take(4))[0]
        n = self.number()
        kind = np.dtype(TYPES[code])
        data = self.take(_padded(n * kind.itemsize))[: n * kind.itemsize]
        if code == 2:
            return data.rstrip(b"\0").decode(errors="replace")
        held = np.frombuffer(data, kind)
        return held[0].item() if n == 1 else held.tolist()

    def attributes(self) -> dict[str, object]:
        kind, n = self.tag()
        if kind not in (0, ATTRIBUTES):
            raise FormatError("no list of attributes where one belongs")
        return {self.name(): self.values() for _ in range(n)}


def read_header(file) -> Header:
    c = _Cursor(file)
    magic = c.take(4)
    if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
        raise FormatError("no classic NetCDF file")
    c.version = magic[3]
    records = c.number()
    kind, n = c.tag()
    if kind not in (0, DIMENSIONS):
        raise FormatError("no list of dimensions where one belongs")
    dims = [(c.name(), c.number()) for _ in range(n)]
    unlimited = next((k for k, (_, size) in enumerate(dims) if size == 0), None)
    sizes = [max(records, 0) if k == unlimited else size for k, (_, size) in enumerate(dims)]
    attrs = c.attributes()
    kind, n = c.tag()
    if kind not in (0, VARIABLES):
        raise FormatError("no list of variables where one belongs")
    variables: dict[str, Variable] = {}
    for _ in range(n):
        name = c.name()
        ids = [c.number() for _ in range(c.number())]
        held = c.attributes()
        code = struct.unpack(">i", c.take(4))[0]
        c.number()  # the size is what the shape says; writers differ for large ones
        variables[name] = Variable(name, tuple(dims[k][0] for k in ids), tuple(sizes[k] for k in ids), code, c.offset(), bool(ids) and ids[0] == unlimited, held)
    of_records = [v for v in variables.values() if v.record]
    one = [int(np.prod(v.shape[1:], dtype=np.int64)) * v.dtype.itemsize for v in of_records]
    record_bytes = one[0] if len(one) == 1 else sum(map(_padded, one))
    return Header(c.version, {d: s for (d, _), s in zip(dims, sizes, strict=True)}, attrs, variables, record_bytes)


def open_file(path: str):
    """A file of any file system that Arrow knows, for reading at places."""
    fs, inner = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs.open_input_file(inner)


def list_files(path: str) -> list[str]:
    """Paths of a file, of a folder's files, of a comma-separated list, or of names with stars in the last part; sorted."""
    out: list[str] = []
    for one in path.split(","):
        folder, name = one.rstrip("/"), "*"
        if "*" in one:
            folder, _, name = one.rpartition("/")
        remote = "://" in one or one.startswith("file:")
        fs, inner = pafs.FileSystem.from_uri(folder) if remote else (pafs.LocalFileSystem(), folder)
        # What stands before a path in its file system: scheme, and host if there is one.
        base = folder[: len(folder) - len(inner)] if remote and folder.endswith(inner) else ""
        if "*" not in one:
            info = fs.get_file_info(inner)
            if info.type == pafs.FileType.File:
                out.append(one)
                continue
            if info.type == pafs.FileType.NotFound:
                raise FileNotFoundError(one)
        test = re.compile(re.escape(name).replace(r"\*", ".*") + r"\Z")
        found = [f.path for f in fs.get_file_info(pafs.FileSelector(inner)) if f.type == pafs.FileType.File and test.match(f.base_name) and not f.base_name.startswith((".", "_")) and not f.base_name.endswith(".incomplete")]
        out += [base + f for f in found]
    return sorted(out)


def read_box(file, header: Header, v: Variable, box: list[tuple[int, int]]) -> np.ndarray:
    """Stored values of a variable for a range of places along each dimension: one read for each stretch that is whole."""
    shape = [b - a for a, b in box]
    item = v.dtype.itemsize
    strides = [item] * len(v.shape)
    for k in range(len(v.shape) - 2, -1, -1):
        strides[k] = strides[k + 1] * v.shape[k + 1]
    if v.record:
        strides[0] = header.record_bytes
    # Dimensions from ``whole`` on are read in one piece with the range of the one before.
    whole = len(v.shape)
    while whole > 0 and not (v.record and whole == 1) and box[whole - 1] == (0, v.shape[whole - 1]):
        whole -= 1
    outer = max(whole - 1, 0) if not (v.record and whole <= 1) else min(1, len(box))
    run = int(np.prod(shape[outer:], dtype=np.int64))
    out = np.empty((int(np.prod(shape[:outer], dtype=np.int64)), run), v.dtype)
    start = v.begin + sum(a * s for (a, _), s in zip(box[outer:], strides[outer:], strict=True))
    for k, at in enumerate(product(*[range(a, b) for a, b in box[:outer]])):
        data = file.read_at(run * item, start + sum(x * s for x, s in zip(at, strides, strict=False)))
        if len(data) < run * item:
            raise FormatError(f"the values of {v.name} end early")
        out[k] = np.frombuffer(data, v.dtype)
    return out.reshape(shape)


def _epoch(v: Variable) -> tuple[float, datetime]:
    m = SINCE.match(str(v.attrs["units"]))
    unit = m[1].lower() + "s"
    if unit not in TIME_UNITS:
        raise FormatError(f"{v.name} is in {v.attrs['units']}, which is no unit of time")
    clock = (m[3] or "00:00").split(":")
    day = [int(x) for x in m[2].split("-")]
    return TIME_UNITS[unit], datetime(*day, *[int(x) for x in clock], tzinfo=timezone.utc)


def decode(v: Variable, stored: np.ndarray) -> pa.Array:
    """Stored values as Spark gets them, in one row: null where missing, scaled, times and texts as such."""
    if v.code == 2:
        flat = np.ascontiguousarray(stored).reshape(-1, max(1, v.text_length)) if v.text_length else stored.reshape(-1, 1)
        return pa.array([bytes(x).rstrip(b"\0").decode(errors="replace") for x in flat.view(f"S{flat.shape[1]}").ravel()], pa.string())
    flat = stored.ravel()
    missing = np.zeros(len(flat), bool)
    for name in ("_FillValue", "missing_value"):
        if isinstance(v.attrs.get(name), (int, float)):
            missing |= flat == np.array(v.attrs[name]).astype(v.dtype)
    native = flat.astype(v.dtype.newbyteorder("="))
    if native.dtype.kind == "f":
        missing |= np.isnan(native)
    if v.is_time:
        unit, start = _epoch(v)
        base = int((start - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))
        micro = np.where(missing, 0, native)
        whole = round(unit * 1e6)
        at = base + (micro.astype(np.int64) * whole if native.dtype.kind in "iu" else np.rint(micro * (unit * 1e6)).astype(np.int64))
        return pa.array(at, pa.timestamp("us", "UTC"), mask=missing)
    if "scale_factor" in v.attrs or "add_offset" in v.attrs:
        scaled = native.astype(np.float64) * float(v.attrs.get("scale_factor", 1)) + float(v.attrs.get("add_offset", 0))
        return pa.array(scaled, pa.float64(), mask=missing)
    wide = {7: np.int16, 8: np.int32, 9: np.int64}
    if v.code == 11:
        return pa.array([None if m else int(x) for x, m in zip(native.tolist(), missing.tolist(), strict=True)], pa.decimal128(20, 0))
    return pa.array(native.astype(wide.get(v.code, native.dtype)), mask=missing)


def spark_type(v: Variable) -> str:
    if v.is_time:
        return "timestamp"
    return "double" if "scale_factor" in v.attrs or "add_offset" in v.attrs else SPARK_TYPES[v.code]


def chosen(header: Header, names: str | None) -> list[Variable]:
    """The asked variables, or all that are no coordinates; FormatError unless they share their dimensions."""
    if names:
        gone = [n for n in names.split(",") if n.strip() not in header.variables]
        if gone:
            raise FormatError(f"no variable {', '.join(gone)} among {', '.join(header.variables)}")
        out = [header.variables[n.strip()] for n in names.split(",")]
    else:
        out = [v for v in header.variables.values() if v.cell_dims and v.name not in header.dims]
    if len({v.cell_dims for v in out}) > 1:
        raise FormatError("variables of different dimensions are different tables: " + ", ".join(f"{v.name}({', '.join(v.cell_dims)})" for v in out))
    return out


def _coordinate(header: Header, dim: str) -> Variable | None:
    v = header.variables.get(dim)
    return v if v is not None and v.cell_dims == (dim,) else None


def _stored_values(v: Variable | None, file, header: Header, a: int, b: int) -> pa.Array:
    if v is None:
        return pa.array(np.arange(a, b, dtype=np.int32))
    box = [(a, b), *[(0, n) for n in v.shape[1:]]]
    return decode(v, read_box(file, header, v, box))


def _range_of(values: pa.Array, tests: list[tuple[str, object]]) -> tuple[int, int]:
    """The first and behind the last place whose value can pass all tests."""
    import pyarrow.compute as pc

    ops = {"==": pc.equal, ">": pc.greater, ">=": pc.greater_equal, "<": pc.less, "<=": pc.less_equal}
    keep = None
    for op, value in tests:
        one = pc.is_in(values, pa.array(value).cast(values.type)) if op == "in" else ops[op](values, pa.scalar(value).cast(values.type) if not isinstance(value, datetime) else pa.scalar(value, values.type))
        keep = one if keep is None else pc.and_(keep, one)
    hit = np.flatnonzero(keep.fill_null(False).to_numpy(zero_copy_only=False))
    return (int(hit[0]), int(hit[-1]) + 1) if len(hit) else (0, 0)


@dataclass
class Slab(InputPartition):
    """Cells of a file: a range of places along each dimension, and tests that the task still has to look up."""

    path: str
    box: list[tuple[int, int]]
    tests: dict[str, list[tuple[str, object]]]
    layout: str  # that the file must have, if it was not looked at

    def __init__(self, path: str, box: list[tuple[int, int]], tests: dict[str, list[tuple[str, object]]], layout: str = ""):
        self.path, self.box, self.tests, self.layout = path, box, tests, layout


def _slabs(box: list[tuple[int, int]], cell_bytes: int, most: int) -> Iterator[list[tuple[int, int]]]:
    """The box in pieces of at most ``most`` bytes, cut along the first dimension that has more than one place."""
    if any(a >= b for a, b in box):
        return
    size = cell_bytes * int(np.prod([b - a for a, b in box], dtype=np.int64))
    k = next((k for k, (a, b) in enumerate(box) if b - a > 1), None)
    if size <= most or k is None:
        yield box
        return
    a, b = box[k]
    step = max(1, (b - a) * most // size)
    for x in range(a, b, step):
        piece = [*box[:k], (x, min(x + step, b)), *box[k + 1 :]]
        if step == 1:
            yield from _slabs(piece, cell_bytes, most)
        else:
            yield piece


class NetcdfReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.options = options
        self.names = options.get("variables")
        self.same_layout = options.get("same_layout", "false").lower() == "true"
        self.decoded = options.get("decode", "true").lower() != "false"
        self.most = int(options.get("slab_bytes", SLAB_BYTES))
        self.tests: dict[str, list[tuple[str, object]]] = {}

    def pushFilters(self, filters):
        """Comparisons of a column with constants make slabs shrink; Spark keeps all filters for the rows."""
        ops = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}
        for f in filters:
            op = ops.get(type(f))
            if op and len(f.attribute) == 1 and f.value is not None:
                self.tests.setdefault(f.attribute[0], []).append((op, list(f.value) if op == "in" else f.value))
            yield f

    def partitions(self) -> list[Slab]:
        out: list[Slab] = []
        header: Header | None = None
        for path in list_files(self.options["path"]):
            if header is None or not self.same_layout:
                with open_file(path) as file:
                    header = read_header(file)
                    variables = chosen(header, self.names)
                    dims = variables[0].cell_dims
                    tests = {d: self.tests[d] for d in dims if d in self.tests}
                    box = [(0, header.dims[d]) for d in dims]
                    if not self.same_layout:
                        box = [_range_of(_stored_values(_coordinate(header, d), file, header, 0, header.dims[d]), tests[d]) if d in tests else x for d, x in zip(dims, box, strict=True)]
            size = sum(v.dtype.itemsize * max(1, v.text_length) for v in variables)
            unseen = (tests, header.layout()) if self.same_layout else ({}, "")
            out += [Slab(path, piece, *unseen) for piece in _slabs(box, size, self.most)]
        return out or [Slab("", [], {})]

    def read(self, slab: Slab) -> Iterator[pa.RecordBatch]:
        if not slab.path:
            return
        with open_file(slab.path) as file:
            header = read_header(file)
            if slab.layout and header.layout() != slab.layout:
                raise FormatError(f"{slab.path} has another layout than the first file")
            variables = chosen(header, self.names)
            dims = variables[0].cell_dims
            coordinates, box = [], []
            for d, (a, b) in zip(dims, slab.box, strict=True):
                values = _stored_values(_coordinate(header, d), file, header, a, b)
                if d in slab.tests:
                    lo, hi = _range_of(values, slab.tests[d])
                    values, a, b = values.slice(lo, hi - lo), a + lo, a + hi
                coordinates.append(values)
                box.append((a, b))
            shape = [b - a for a, b in box]
            n = int(np.prod(shape, dtype=np.int64))
            if not n:
                return
            held = [read_box(file, header, v, [*box, *([(0, v.text_length)] if v.text_length else [])]).reshape(n, *([v.text_length] if v.text_length else [])) for v in variables]
            name = posixpath.basename(slab.path)
            for at in range(0, n, BATCH_ROWS):
                place = np.unravel_index(np.arange(at, min(at + BATCH_ROWS, n)), shape)
                columns = [c.take(pa.array(p)) for c, p in zip(coordinates, place, strict=True)]
                columns += [decode(v if self.decoded else Variable(v.name, v.dims, v.shape, v.code, v.begin), x[at : at + BATCH_ROWS]) for v, x in zip(variables, held, strict=True)]
                columns.append(pa.array([name] * len(place[0])))
                yield pa.RecordBatch.from_arrays(columns, names=[*dims, *[v.name for v in variables], "file"])


class HeaderReader(DataSourceReader):
    """What files say of themselves: one row a variable or global attribute, a group of files a task."""

    def __init__(self, options) -> None:
        self.path, self.group = options["path"], int(options.get("files_per_task", 64))

    def partitions(self) -> list[InputPartition]:
        files = list_files(self.path)
        return [InputPartition(files[k : k + self.group]) for k in range(0, len(files), self.group)] or [InputPartition([])]

    def read(self, part: InputPartition) -> Iterator[tuple]:
        for path in part.value:
            with open_file(path) as file:
                header = read_header(file)
            name = posixpath.basename(path)
            for v in header.variables.values():
                yield name, v.name, list(v.cell_dims), [header.dims[d] for d in v.cell_dims], spark_type(v), {k: str(x) for k, x in v.attrs.items()}
            yield name, "", [], [], "", {k: str(x) for k, x in header.attrs.items()}


HEADER_SCHEMA = "file string, variable string, dims array<string>, shape array<int>, type string, attrs map<string,string>"


def _name_bytes(text: str, wide: bool) -> bytes:
    data = text.encode()
    return struct.pack(">q" if wide else ">i", len(data)) + data.ljust(_padded(len(data)), b"\0")


def _attribute_bytes(attrs: dict[str, object], wide: bool) -> bytes:
    count = struct.pack(">q" if wide else ">i", len(attrs))
    if not attrs:
        return struct.pack(">i", 0) + count
    out = struct.pack(">i", ATTRIBUTES) + count
    for k, x in attrs.items():
        if isinstance(x, str):
            code, data, n = 2, x.encode(), len(x.encode())
        else:
            values = x if isinstance(x, np.ndarray) else np.atleast_1d(np.asarray(x))
            if values.dtype.kind in "iu" and values.dtype.itemsize == 8 and (np.abs(values) < 2**31).all():
                values = values.astype(np.int32)
            kind = values.dtype.newbyteorder(">") if values.dtype.itemsize > 1 else values.dtype
            code, data, n = CODES[kind], values.astype(kind).tobytes(), len(values)
        out += _name_bytes(k, wide) + struct.pack(">i", code) + struct.pack(">q" if wide else ">i", n) + data.ljust(_padded(len(data)), b"\0")
    return out


def file_head(dims: dict[str, int], variables: list[tuple[str, tuple[str, ...], np.dtype, int, dict[str, object]]], attrs: dict[str, object]) -> bytes:
    """A classic file's header, of variables with their types, numbers of values and attributes."""
    wide = any(t.kind in "iu" and (t.itemsize == 8 or t.kind == "u") for _, _, t, _, _ in variables)
    number = lambda x: struct.pack(">q" if wide else ">i", x)
    listing = lambda tag, n: struct.pack(">i", tag if n else 0) + number(n)
    order = list(dims)
    head = b"CDF" + bytes([5 if wide else 2]) + number(0) + listing(DIMENSIONS, len(dims)) + b"".join(_name_bytes(d, wide) + number(n) for d, n in dims.items())
    head += _attribute_bytes(attrs, wide) + listing(VARIABLES, len(variables))
    parts = []
    for name, of, t, size, held in variables:
        start = _name_bytes(name, wide) + number(len(of)) + b"".join(number(order.index(d)) for d in of) + _attribute_bytes(held, wide)
        data = _padded(size * t.itemsize)
        parts.append((start + struct.pack(">i", CODES[_stored(t)]) + number(min(data, 2**31 - 4) if not wide else data), data))
    begin = len(head) + sum(len(p) + 8 for p, _ in parts)
    for p, data in parts:
        head += p + struct.pack(">q", begin)
        begin += data
    return head


def _stored(t: np.dtype) -> np.dtype:
    return t if t.itemsize == 1 else t.newbyteorder(">")


def file_bytes(dims: dict[str, int], variables: list[tuple[str, tuple[str, ...], np.ndarray, dict[str, object]]], attrs: dict[str, object]) -> Iterator[bytes]:
    """A classic file in pieces: the header, then each variable's values (arrays of one of the format's types)."""
    yield file_head(dims, [(name, of, a.dtype, a.size, held) for name, of, a, held in variables], attrs)
    for _, _, a, _ in variables:
        data = np.ascontiguousarray(a).astype(_stored(a.dtype)).tobytes()
        yield data.ljust(_padded(len(data)), b"\0")


def _encoded(name: str, column: pa.ChunkedArray, enc: dict[str, object], missing: bool = False, width: int = 1) -> tuple[np.ndarray, dict[str, object]]:
    """A column as one of the format's types, with the attributes that say how; missing values as fill.

    Of a piece of a column, ``missing`` says that the column lacks values somewhere, and ``width`` its longest text's bytes.
    """
    t = column.type
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        texts = [x.encode() if x else b"" for x in column.to_pylist()]
        width = max([width, *map(len, texts)])
        return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in texts), "S1").reshape(-1, width), {}
    if pa.types.is_timestamp(t) or pa.types.is_date(t):
        # Doubles hold whole microseconds exactly up to the year 2255.
        micro = column.cast(pa.timestamp("us")).cast(pa.int64())
        held = micro.to_numpy(zero_copy_only=False).astype(np.float64) if micro.null_count == 0 else micro.to_pandas().to_numpy(np.float64)
        return np.where(np.isnan(held), -9.0e18, held), {"units": "microseconds since 1970-01-01 00:00:00", "_FillValue": np.float64(-9.0e18)}
    if pa.types.is_decimal(t):
        column, t = column.cast(pa.float64()), pa.float64()
    if pa.types.is_boolean(t):
        column, t = column.cast(pa.int8()), pa.int8()
    kind = np.dtype(t.to_pandas_dtype())
    fill = enc.get("_FillValue")
    if column.null_count or missing:
        if fill is None:
            fill = 9.969209968386869e36 if kind.kind == "f" else np.iinfo(kind).min + 1
        column = column.fill_null(pa.scalar(np.array(fill).astype(kind).item(), t))
    held = column.to_numpy(zero_copy_only=False).astype(kind)
    return held, {"_FillValue": np.array([fill]).astype(kind)} if fill is not None else {}


def target_file(table: pa.Table, dims: list[str], attrs: dict[str, object], var_attrs: dict[str, dict[str, object]], encoding: dict[str, dict[str, object]], scalars: dict[str, object] | None = None) -> Iterator[bytes]:
    """A table's rows as one file: a cell a combination of the dimensions' values, cells without a row missing.

    Scalars (a coordinate system, say) are variables without dimensions, for the sake of their attributes.
    """
    sizes: dict[str, int] = {}
    variables: list[tuple[str, tuple[str, ...], np.ndarray, dict[str, object]]] = []
    place = np.zeros(table.num_rows, np.int64)

    def add(name: str, of: tuple[str, ...], values: np.ndarray, how: dict[str, object], shape: list[int]) -> None:
        if values.dtype == np.dtype("S1"):
            width = f"{name}_length"
            sizes[width] = values.shape[-1]
            of, shape = (*of, width), [*shape, values.shape[-1]]
        variables.append((name, of, values.reshape(shape), {**var_attrs.get(name, {}), **how}))

    for d in dims:
        column = table.column(d)
        if column.null_count:
            raise ValueError(f"dimension {d} has rows without a value")
        levels = column.combine_chunks().dictionary_encode() if not isinstance(column, pa.Array) else column.dictionary_encode()
        levels = levels.combine_chunks() if isinstance(levels, pa.ChunkedArray) else levels
        order = np.asarray(pa.compute.sort_indices(levels.dictionary))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        sizes[d] = len(order)
        place = place * len(order) + rank[levels.indices.to_numpy(zero_copy_only=False)]
        values, how = _encoded(d, pa.chunked_array([levels.dictionary.take(pa.array(order))]), {})
        add(d, (d,), values, how, [len(order)])
    shape = [sizes[d] for d in dims]
    cells = int(np.prod(shape, dtype=np.int64))
    if len(np.unique(place)) != table.num_rows:
        raise ValueError("several rows of one file are one cell")
    whole = cells == table.num_rows
    source = np.empty(cells, np.int64) if whole else np.full(cells, -1, np.int64)
    source[place] = np.arange(table.num_rows)
    rows = pa.array(source) if whole else pa.array(source, mask=source < 0)
    for name in table.column_names:
        if name not in dims:
            values, how = _encoded(name, table.column(name).take(rows), encoding.get(name, {}))
            scaling = {k: np.float64(encoding[name][k]) for k in ("scale_factor", "add_offset") if name in encoding and k in encoding[name] and encoding[name].get("dtype") == "int32"}
            add(name, tuple(dims), values, {**how, **scaling}, shape)
    for name, value in (scalars or {}).items():
        held = np.asarray(value if isinstance(value, (int, float)) else 0)
        variables.append((name, (), held.astype(np.float64 if held.dtype.kind == "f" else np.int32), var_attrs.get(name, {})))
    return file_bytes(sizes, variables, attrs)


class Spool:
    """One target's rows on the task's own disk, in the order of their dimensions, so that a file is made a piece at a time.

    Held are one batch, and the values of all dimensions but the first. ``sorted`` becomes false when rows come in another
    order (or lack a dimension's value); such a target is made from a whole table.
    """

    def __init__(self, schema: pa.Schema, dims: list[str]) -> None:
        self.dims, self.rows, self.sorted = dims, 0, True
        self.schema = schema
        self.folder = tempfile.TemporaryDirectory(prefix="netcdf-")
        self.path = f"{self.folder.name}/rows.arrow"
        self.out = pa.ipc.new_file(self.path, schema)
        self.first, self.before = 0, None  # values of the first dimension so far, and the last of them
        self.levels: dict[str, pa.Array] = {d: pa.array([], schema.field(d).type) for d in dims[1:]}
        self.missing = dict.fromkeys(schema.names, False)
        self.width = dict.fromkeys(schema.names, 1)

    def _turns(self, column: pa.Array, before: pa.Scalar | None) -> tuple[np.ndarray, bool]:
        """Where a new value of the first dimension begins, and whether values only rise."""
        if before is not None:
            column = pa.concat_arrays([pa.array([before.as_py()], column.type), column])
        a, b = column[:-1], column[1:]
        turns = pa.compute.not_equal(a, b).to_numpy(zero_copy_only=False).astype(bool)
        rising = not len(a) or pa.compute.all(pa.compute.less_equal(a, b)).as_py()
        return (turns if before is not None else np.r_[True, turns]), bool(rising)

    def add(self, batch: pa.RecordBatch) -> None:
        if not batch.num_rows:
            return
        self.out.write_batch(batch)
        self.rows += batch.num_rows
        for n, column in zip(batch.schema.names, batch.columns, strict=True):
            self.missing[n] |= column.null_count > 0
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                self.width[n] = max(self.width[n], pa.compute.max(pa.compute.binary_length(column)).as_py() or 1)
        held = [batch.column(d) for d in self.dims]
        if not self.dims or any(c.null_count or (pa.types.is_floating(c.type) and pa.compute.any(pa.compute.is_nan(c)).as_py()) for c in held):
            self.sorted = False
        if self.sorted:
            turns, self.sorted = self._turns(held[0], self.before)
            self.first += int(turns.sum())
            self.before = held[0][-1]
            for d, c in zip(self.dims[1:], held[1:], strict=True):
                self.levels[d] = pa.compute.unique(pa.concat_arrays([self.levels[d], c]))

    def close(self) -> None:
        self.out.close()
        for d, v in self.levels.items():
            self.levels[d] = v.take(pa.compute.sort_indices(v))

    def batches(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        fields = [self.schema.get_field_index(n) for n in names]
        with pa.OSFile(self.path) as file, pa.ipc.open_file(file, options=pa.ipc.IpcReadOptions(included_fields=fields)) as reader:
            for k in range(reader.num_record_batches):
                yield reader.get_batch(k)

    def table(self) -> pa.Table:
        return pa.Table.from_batches(list(self.batches(self.schema.names)), self.schema)

    def placed(self, name: str | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Batches of the dimensions and one variable, with their rows' cells."""
        at, before = -1, None
        for batch in self.batches([*self.dims, *([name] if name else [])]):
            first = batch.column(self.dims[0])
            place = at + np.cumsum(self._turns(first, before)[0])
            at, before = int(place[-1]), first[-1]
            for d in self.dims[1:]:
                place = place * len(self.levels[d]) + pa.compute.index_in(batch.column(d), value_set=self.levels[d]).to_numpy(zero_copy_only=False)
            yield batch, place

    def in_order(self) -> bool:
        """Whether each row's cell is after the one before; rows of one cell are an error."""
        last = -1
        for _, place in self.placed() if self.sorted and len(self.dims) > 1 else ():
            steps = np.diff(place, prepend=last)
            if (steps < 0).any() or (steps == 0).any():
                return False
            last = int(place[-1])
        # Of one dimension, as many values as rows.
        return self.sorted and (len(self.dims) > 1 or self.first == self.rows)


PIECE_CELLS = 1 << 18


def spooled_file(spool: Spool, attrs: dict[str, object], var_attrs: dict[str, dict[str, object]], encoding: dict[str, dict[str, object]], scalars: dict[str, object] | None = None) -> Iterator[bytes]:
    """What ``target_file`` makes of the same rows, a piece at a time."""
    dims = spool.dims
    if not spool.in_order():
        yield from target_file(spool.table(), dims, attrs, var_attrs, encoding, scalars)
        return
    sizes: dict[str, int] = {}
    variables: list[tuple[str, tuple[str, ...], np.dtype, int, dict[str, object]]] = []
    lengths = {d: len(spool.levels[d]) if d in spool.levels else spool.first for d in dims}
    cells = int(np.prod(list(lengths.values()), dtype=np.int64))
    gaps = cells > spool.rows

    def empty(name: str, how: dict[str, object], missing: bool) -> tuple[np.ndarray, dict[str, object]]:
        return _encoded(name, pa.chunked_array([pa.nulls(1 if missing else 0, spool.schema.field(name).type)]), how, missing, spool.width[name])

    def add(name: str, of: tuple[str, ...], size: int, sample: np.ndarray, how: dict[str, object]) -> None:
        if sample.dtype == np.dtype("S1"):
            sizes[f"{name}_length"] = spool.width[name]
            of, size = (*of, f"{name}_length"), size * spool.width[name]
        variables.append((name, of, sample.dtype, size, {**var_attrs.get(name, {}), **how}))

    for d in dims:
        sizes[d] = lengths[d]
        add(d, (d,), lengths[d], *empty(d, {}, False))
    others = [n for n in spool.schema.names if n not in dims]
    lacking = {n: spool.missing[n] or gaps for n in others}
    for name in others:
        enc = encoding.get(name, {})
        scaling = {k: np.float64(enc[k]) for k in ("scale_factor", "add_offset") if k in enc and enc.get("dtype") == "int32"}
        sample, how = empty(name, enc, lacking[name])
        add(name, tuple(dims), cells, sample, {**how, **scaling})
    constants = []
    for name, value in (scalars or {}).items():
        held = np.asarray(value if isinstance(value, (int, float)) else 0)
        constants.append(held.astype(np.float64 if held.dtype.kind == "f" else np.int32))
        variables.append((name, (), constants[-1].dtype, 1, var_attrs.get(name, {})))
    yield file_head(sizes, variables, attrs)

    def stored(a: np.ndarray) -> bytes:
        return np.ascontiguousarray(a).astype(_stored(a.dtype)).tobytes()

    def coordinate(d: str) -> Iterator[bytes]:
        if d in spool.levels:
            yield stored(_encoded(d, pa.chunked_array([spool.levels[d]]), {}, width=spool.width[d])[0])
            return
        before = None
        for batch in spool.batches([d]):
            column = batch.column(d)
            yield stored(_encoded(d, pa.chunked_array([column.filter(pa.array(spool._turns(column, before)[0]))]), {}, width=spool.width[d])[0])
            before = column[-1]

    def values(name: str) -> Iterator[bytes]:
        def encoded(column: pa.Array) -> np.ndarray:
            return _encoded(name, pa.chunked_array([column]), encoding.get(name, {}), lacking[name], spool.width[name])[0]

        if not gaps:
            for batch in spool.batches([name]):
                yield stored(encoded(batch.column(name)))
            return
        fill, done = empty(name, encoding.get(name, {}), True)[0], 0
        for batch, place in spool.placed(name):
            held = encoded(batch.column(name))
            while done <= place[-1]:
                end = min(done + PIECE_CELLS, int(place[-1]) + 1)
                a, b = np.searchsorted(place, [done, end])
                piece = np.repeat(fill, end - done, axis=0)
                piece[place[a:b] - done] = held[a:b]
                yield stored(piece)
                done = end
        while done < cells:
            end = min(done + PIECE_CELLS, cells)
            yield stored(np.repeat(fill, end - done, axis=0))
            done = end

    for pieces in [*map(coordinate, dims), *map(values, others), *[iter([stored(c)]) for c in constants]]:
        n = 0
        for piece in pieces:
            n += len(piece)
            yield piece
        yield b"\0" * (_padded(n) - n)


@dataclass
class Written(WriterCommitMessage):
    targets: list[str]


class NetcdfWriter(DataSourceArrowWriter):
    def __init__(self, options) -> None:
        import json

        self.folder = options["path"].rstrip("/")
        self.dims = json.loads(options["dims"])
        self.about = json.loads(options.get("about", "{}"))

    def _fs(self):
        return pafs.FileSystem.from_uri(self.folder) if "://" in self.folder or self.folder.startswith("file:") else (pafs.LocalFileSystem(), self.folder)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = self._fs()
        done: list[str] = []
        spool: Spool | None = None
        last = None
        try:
            for batch in batches:
                targets = batch.column(batch.schema.get_field_index("target")).fill_null("None")
                rows = batch.drop_columns(["target"])
                changes = np.flatnonzero(pa.compute.not_equal(targets[:-1], targets[1:]).to_numpy(zero_copy_only=False)) + 1
                cuts = [0, *changes.tolist(), batch.num_rows]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    if b > a:
                        target = targets[a].as_py()
                        if spool is None or target != last:
                            self._flush(fs, folder, spool, last, done)
                            spool, last = Spool(rows.schema, self.dims), target
                        spool.add(rows.slice(a, b - a))
            self._flush(fs, folder, spool, last, done)
        except Exception:
            for t in done:
                fs.delete_file(f"{folder}/{t}.incomplete")
            raise
        return Written(done)

    def _flush(self, fs, folder: str, spool: Spool | None, target: str, done: list[str]) -> None:
        if spool is None:
            return
        spool.close()
        if target in done:
            raise ValueError(f"rows of {target} are not together")
        path = f"{folder}/{target}"
        fs.create_dir(posixpath.dirname(path), recursive=True)
        done.append(target)
        with spool.folder, fs.open_output_stream(f"{path}.incomplete") as out:
            for piece in spooled_file(spool, self.about.get("attrs", {}), self.about.get("var_attrs", {}), self.about.get("encoding", {}), self.about.get("scalars", {})):
                out.write(piece)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = self._fs()
        targets = [t for m in messages if m for t in m.targets]
        twice = sorted({t for t in targets if targets.count(t) > 1}) if len(set(targets)) < len(targets) else []
        there = [t for t in targets if fs.get_file_info(f"{folder}/{t}").type != pafs.FileType.NotFound]
        if twice or there:
            self.abort(messages)
            raise FileExistsError(f"not written: {', '.join((twice or there)[:5])}")
        for t in targets:
            fs.move(f"{folder}/{t}.incomplete", f"{folder}/{t}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = self._fs()
        for t in {t for m in messages if m for t in m.targets}:
            if fs.get_file_info(f"{folder}/{t}.incomplete").type != pafs.FileType.NotFound:
                fs.delete_file(f"{folder}/{t}.incomplete")


class NetcdfSource(DataSource):
    """Options: path, variables (comma-separated), decode, same_layout, slab_bytes, header; to write: dims and about (JSON)."""

    @classmethod
    def name(cls) -> str:
        return "netcdf"

    def _header(self) -> bool:
        return self.options.get("header", "false").lower() == "true"

    def schema(self) -> str:
        if self._header():
            return HEADER_SCHEMA
        files = list_files(self.options["path"])
        if not files:
            raise FileNotFoundError(self.options["path"])
        with open_file(files[0]) as file:
            header = read_header(file)
        variables = chosen(header, self.options.get("variables"))
        decoded = self.options.get("decode", "true").lower() != "false"
        columns = [(d, spark_type(c) if (c := _coordinate(header, d)) else "int") for d in variables[0].cell_dims]
        columns += [(v.name, spark_type(v) if decoded else SPARK_TYPES[v.code]) for v in variables]
        return ", ".join(f"`{n}` {t}" for n, t in [*columns, ("file", "string")])

    def reader(self, schema: StructType) -> DataSourceReader:
        return HeaderReader(self.options) if self._header() else NetcdfReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> NetcdfWriter:
        return NetcdfWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NetcdfSource)


def read_netcdf(spark: SparkSession, path: str, variables: list[str] | None = None, **options) -> DataFrame:
    """Cells of the files' variables, with their ``file``; all variables that share the dimensions of the asked ones."""
    register(spark)
    more = {"variables": ",".join(variables)} if variables else {}
    return spark.read.format("netcdf").options(path=path, **more, **{k: str(v).lower() for k, v in options.items()}).load()


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, variable, dims, shape, type, attrs), one row a variable; the row without a variable has the file's own."""
    register(spark)
    return spark.read.format("netcdf").options(path=path, header="true").load()


def netcdf_dataset(spark: SparkSession, path: str, variables: list[str] | None = None, **options) -> Dataset:
    """The files as a dataset, with the attributes that the first one has."""
    df = read_netcdf(spark, path, variables, **options)
    with open_file(list_files(path)[0]) as file:
        header = read_header(file)
    own = chosen(header, ",".join(variables) if variables else None)
    keep = {"_FillValue", "missing_value", "scale_factor", "add_offset"}
    attrs = {v.name: {k: x for k, x in v.attrs.items() if k not in keep} for v in header.variables.values() if v.name in df.columns}
    encoding = {v.name: {k: x for k, x in v.attrs.items() if k in keep} for v in own}
    return from_table(df, own[0].cell_dims, file_key=("file",), attrs=header.attrs, var_attrs=attrs, encoding={k: e for k, e in encoding.items() if e})


def file_grid(path: str, x: str | None = None, y: str | None = None, crs: str | None = None) -> Grid:
    """The grid of a projection file: its axes, and the coordinate system's text that an attribute holds.

    Reads the header and two coordinates of one file. KeyError names what is not there, ValueError an uneven axis.
    """
    with open_file(path) as file:
        header = read_header(file)

        def axis(name: str | None, names: tuple[str, ...]) -> Axis:
            found = name or next((n for n in names if _coordinate(header, n)), None)
            v = _coordinate(header, found) if found else None
            if v is None:
                raise KeyError(f"no coordinate {name or ' or '.join(names)}")
            values = np.asarray(_stored_values(v, file, header, 0, v.shape[0]).to_numpy(zero_copy_only=False), float)
            if not len(values):
                raise ValueError(f"{found} has no values")
            step = (values[-1] - values[0]) / (len(values) - 1) if len(values) > 1 else 1.0
            if len(values) > 1 and (not step or np.abs((values - values[0]) / step - np.arange(len(values))).max() > EVEN):
                raise ValueError(f"the steps of {found} are uneven")
            return Axis(float(values[0]), float(step), len(values))

        named = crs or next((n for n in CRS_NAMES if n in header.variables), None)
        held = header.variables[named].attrs if named in header.variables else {}
        return Grid(axis(x, X_NAMES), axis(y, Y_NAMES), str(next((held[n] for n in WKT_NAMES if n in held), "")))


def write_masks(rings: DataFrame, grid: Grid, directory: str, label: str = "label", ring: str = "ring", all_touched: bool = True, template: str | None = None, crs: str = "crs") -> DataFrame:
    """Polygons, rasterised, as mask files: one a label, with ones at its cells, and the grid's system as an attribute."""
    masks = mask_cells(rings, grid, label, ring, all_touched)
    attrs = {"mask": {"grid_mapping": crs}, crs: {"spatial_ref": grid.crs}} if grid.crs else {}
    data = from_table(masks, ("y", "x"), var_attrs=attrs, scalars={crs: 0} if grid.crs else {})
    return write_files(data, directory, template or f"mask_{{{label}}}.nc")


def write_files(data: Dataset, directory: str, template: str, conditions: dict[str, object] | None = None, pack_values: bool = False, values: dict[str, object] | None = None) -> DataFrame:
    """One classic file a target; all appear, or none does. Returns (target) of what was written.

    The template's variables are columns, which its files then lack, unless they are dimensions. A target's rows meet in
    one task: a file is one stream. Targets that two files of the dataset share, or that exist, are refused.
    """
    import json

    spark = data.df.sparkSession
    register(spark)
    data = data.with_df(data.df.where(include_conditions(conditions)) if conditions else data.df)
    for n in template_variables(template):
        if n not in data.df.columns:
            template = template.replace("{" + n + "}", fill_template("{" + n + "}", values or {}, data.metadata, data.attrs))
    targets = save_targets(data.df, template, keys=list(data.file_key))
    twice = [r["target"] for r in duplicate_targets(targets).limit(5).collect()]
    if twice:
        raise FileExistsError(f"several files would be {', '.join(twice)}")
    # The name is made of the values as they are; packing comes after.
    named = data.with_df(data.df.withColumn("target", target_name(template)))
    out = packed(named) if pack_values else named.df
    gone = [c for c in {*template_variables(template), *data.file_key} if c not in data.dims]
    rows = out.drop(*gone)
    encoding = default_encoding(data) if pack_values else data.encoding
    plain = {n: {k: v for k, v in e.items() if isinstance(v, (int, float, str))} for n, e in encoding.items()}
    about = {"attrs": {k: v for k, v in data.attrs.items() if isinstance(v, (int, float, str))}, "var_attrs": data.var_attrs, "encoding": plain, "scalars": {k: v for k, v in data.scalars.items() if isinstance(v, (int, float, str))}}
    rows = rows.repartition("target").sortWithinPartitions("target", *data.dims)
    rows.write.format("netcdf").mode("append").options(path=directory, dims=json.dumps(list(data.dims)), about=json.dumps(about, default=str)).save()
    return targets.select("target").distinct()


