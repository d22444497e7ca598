"""Coordinate systems: their text form, and the closed forms of map projections as column expressions.

Read are geographic systems, and on a sphere or an ellipsoid the conformal conic projection (one or two standard
parallels), polar stereographic and Mercator ones. Between two systems a point goes by its longitude and latitude;
datums are not shifted, as model grids on a sphere mean their latitudes as they are.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = re.compile(r'\s*(?:"((?:[^"]|"")*)"|([A-Za-z_][\w.]*)|([-+]?[\d.]+(?:[eE][-+]?\d+)?)|([\[\](),]))')
#: Names of projections in such texts, in lower case without separators, by what they are.
METHODS = {
    "lambertconformalconic": "conic", "lambertconformalconic1sp": "conic", "lambertconformalconic2sp": "conic",
    "polarstereographic": "polar", "stereographicnorthpole": "polar", "stereographicsouthpole": "polar", "stereographic": "polar", "polarstereographicvarianta": "polar", "polarstereographicvariantb": "polar",
    "mercator": "mercator", "mercator1sp": "mercator", "mercator2sp": "mercator", "mercatorauxiliarysphere": "sphere mercator", "popularvisualisationpseudomercator": "sphere mercator",
}
QUARTER, HALF = math.pi / 4, math.pi / 2


class UnknownSystem(ValueError):
    """A text that is no coordinate system, or one of a projection that is not read here."""


def parse_text(text: str) -> list:
    """The nested lists of a system's text: [KEYWORD, item, ...], items being lists, texts or numbers."""
    stack: list[list] = [[]]
    at = 0
    text = text.strip()
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            raise UnknownSystem(f"no coordinate system's text: {text[at : at + 30]!r}")
        at = m.end()
        quoted, word, number, sign = m.groups()
        if quoted is not None:
            stack[-1].append(quoted.replace('""', '"'))
        elif word:
            after = text[at:].lstrip()[:1]
            if after in ("[", "("):
                stack.append([word.upper()])
                at = text.index(after, at) + 1
            else:
                stack[-1].append(word)
        elif number:
            stack[-1].append(float(number))
        elif sign in ("]", ")"):
            if len(stack) < 2:
                raise UnknownSystem("a bracket closes that none opened")
            done = stack.pop()
            stack[-1].append(done)
    if len(stack) != 1 or len(stack[0]) != 1 or not isinstance(stack[0][0], list):
        raise UnknownSystem("no coordinate system's text: brackets do not match")
    return stack[0][0]


def _find(node: list, *keywords: str) -> list[list]:
    """All inner lists of a keyword, outer ones first."""
    out, todo = [], [node]
    while todo:
        x = todo.pop(0)
        if x[0] in keywords:
            out.append(x)
        todo += [c for c in x[1:] if isinstance(c, list)]
    return out


@dataclass(frozen=True)
class System:
    """A coordinate system: ``method`` is geographic, conic, polar or mercator; angles in radians, lengths in metres."""

    method: str
    radius: float
    flattening: float = 0.0  # 0 on a sphere
    meridian: float = 0.0
    origin: float = 0.0  # latitude
    parallels: tuple[float, ...] = ()
    scale: float = 1.0
    east: float = 0.0
    north: float = 0.0
    unit: float = 1.0  # metres, or radians of a geographic one

    @property
    def e(self) -> float:
        return math.sqrt(self.flattening * (2 - self.flattening))

    # Numbers of the system

    def _t(self, phi: float) -> float:
        s = self.e * math.sin(phi)
        return math.tan(QUARTER - phi / 2) / ((1 - s) / (1 + s)) ** (self.e / 2)

    def _m(self, phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (self.e * math.sin(phi)) ** 2)

    def _cone(self) -> tuple[float, float, float]:
        """n, the radius factor, and the radius at the origin."""
        first = self.parallels[0] if self.parallels else self.origin
        last = self.parallels[-1] if self.parallels else self.origin
        n = math.sin(first) if abs(first - last) < 1e-12 else math.log(self._m(first) / self._m(last)) / math.log(self._t(first) / self._t(last))
        if abs(n) < 1e-12:
            raise UnknownSystem("the cone's parallels lie opposite each other")
        factor = self.radius * self.scale * self._m(first) / (n * self._t(first) ** n)
        return n, factor, 0.0 if abs(abs(self.origin) - HALF) < 1e-12 else factor * self._t(self.origin) ** n

    def _pole(self) -> tuple[float, float]:
        """1 or -1, the pole, and the radius for t = 1."""
        true = abs(self.parallels[0]) if self.parallels else HALF
        if abs(true - HALF) < 1e-12:
            e = self.e
            return math.copysign(1.0, self.origin), 2 * self.radius * self.scale / math.sqrt((1 + e) ** (1 + e) * (1 - e) ** (1 - e))
        return math.copysign(1.0, self.origin), self.radius * self.scale * self._m(true) / self._t(true)

    def _line(self) -> float:
        return self.radius * self.scale * (self._m(self.parallels[0]) if self.parallels else 1.0)

    # Columns

    def _t_of(self, phi: Column) -> Column:
        t = F.tan(F.lit(QUARTER) - phi / 2)
        if not self.e:
            return t
        s = F.sin(phi) * self.e
        return t / F.pow((1 - s) / (1 + s), F.lit(self.e / 2))

    def _phi_of(self, t: Column) -> Column:
        """Latitude from t, by the series of the conformal latitude: exact to about 1e-11 on the earth's ellipsoids."""
        chi = F.lit(HALF) - 2 * F.atan(t)
        e2 = self.e**2
        if not e2:
            return chi
        a = e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12 + 13 * e2**4 / 360
        b = 7 * e2**2 / 48 + 29 * e2**3 / 240 + 811 * e2**4 / 11520
        c = 7 * e2**3 / 120 + 81 * e2**4 / 1120
        d = 4279 * e2**4 / 161280
        return chi + a * F.sin(2 * chi) + b * F.sin(4 * chi) + c * F.sin(6 * chi) + d * F.sin(8 * chi)

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """Coordinates of points given in degrees."""
        lam, phi = F.radians(lon), F.radians(lat)
        if self.method == "geographic":
            return lam / self.unit, phi / self.unit
        turn = lam - self.meridian
        turn = turn - 2 * math.pi * F.floor((turn + math.pi) / (2 * math.pi))
        if self.method == "conic":
            n, factor, at_origin = self._cone()
            rho, theta = factor * F.pow(self._t_of(phi), F.lit(n)), turn * n
            x, y = rho * F.sin(theta), F.lit(at_origin) - rho * F.cos(theta)
        elif self.method == "polar":
            pole, k = self._pole()
            rho = k * self._t_of(phi * pole)
            x, y = rho * F.sin(turn), -pole * rho * F.cos(turn)
        else:
            k = self._line()
            x, y = k * turn, -k * F.log(self._t_of(phi))
        return (x + self.east) / self.unit, (y + self.north) / self.unit

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Longitude and latitude in degrees of points given in this system."""
        if self.method == "geographic":
            return F.degrees(x * self.unit), F.degrees(y * self.unit)
        x, y = x * self.unit - self.east, y * self.unit - self.north
        if self.method == "conic":
            n, factor, at_origin = self._cone()
            sign = math.copysign(1.0, n)
            down = F.lit(at_origin) - y
            rho = F.sqrt(x * x + down * down)
            turn, phi = F.atan2(x * sign, down * sign) / n, self._phi_of(F.pow(rho / abs(factor), F.lit(1 / n)))
        elif self.method == "polar":
            pole, k = self._pole()
            rho = F.sqrt(x * x + y * y)
            turn, phi = F.atan2(x, -pole * y), pole * self._phi_of(rho / k)
        else:
            k = self._line()
            turn, phi = x / k, self._phi_of(F.exp(-y / k))
        lam = turn + self.meridian
        lam = lam - 2 * math.pi * F.floor((lam + math.pi) / (2 * math.pi))
        return F.degrees(lam), F.degrees(phi)


def system_of(text: str) -> System:
    """The system that a text says; UnknownSystem names what is not read."""
    tree = parse_text(text)
    shape = _find(tree, "SPHEROID", "ELLIPSOID")
    if not shape or len(shape[0]) < 4:
        raise UnknownSystem("the text names no ellipsoid")
    radius, inverse = float(shape[0][2]), float(shape[0][3])
    flattening = 1 / inverse if inverse else 0.0
    if tree[0] in ("GEOGCS", "GEOGCRS", "GEODCRS"):
        units = [float(c[2]) for c in tree[1:] if isinstance(c, list) and c[0] in ("UNIT", "ANGLEUNIT")]
        return System("geographic", radius, flattening, unit=units[-1] if units else math.pi / 180)
    if tree[0] not in ("PROJCS", "PROJCRS"):
        raise UnknownSystem(f"{tree[0]} is neither a geographic nor a projected system")
    named = _find(tree, "PROJECTION", "METHOD")
    name = re.sub(r"[^a-z0-9]", "", str(named[0][1]).lower()) if named else ""
    method = METHODS.get(name)
    if method is None:
        raise UnknownSystem(f"the projection '{named[0][1] if named else ''}' is not read here")
    unit = [float(c[2]) for c in tree[1:] if isinstance(c, list) and c[0] in ("UNIT", "LENGTHUNIT")]
    unit_ = unit[-1] if unit else 1.0
    given = {re.sub(r"[^a-z0-9]", "", str(p[1]).lower()): float(p[2]) for p in _find(tree, "PARAMETER")}
    angle = lambda *names: next((math.radians(given[n]) for n in names if n in given), None)
    number = lambda default, *names: next((given[n] for n in names if n in given), default)
    parallels = tuple(a for a in (angle("standardparallel1", "latitudeof1ststandardparallel", "latitudeofstandardparallel"), angle("standardparallel2", "latitudeof2ndstandardparallel")) if a is not None)
    origin = angle("latitudeoforigin", "latitudeofcenter", "latitudeoffalseorigin", "latitudeofnaturalorigin")
    meridian = angle("centralmeridian", "longitudeoforigin", "longitudeofcenter", "straightverticallongitudefrompole", "longitudeoffalseorigin", "longitudeofnaturalorigin") or 0.0
    scale = number(1.0, "scalefactor", "scalefactoratnaturalorigin")
    east, north = (number(0.0, *n) * unit_ for n in (("falseeasting", "eastingatfalseorigin"), ("falsenorthing", "northingatfalseorigin")))
    if method == "polar":
        if name == "stereographic" and (origin is None or abs(abs(origin) - HALF) > 1e-9):
            raise UnknownSystem("stereographic projections are read about a pole only")
        south = name == "stereographicsouthpole" or (origin if origin is not None else parallels[0] if parallels else 1.0) < 0
        if not parallels and origin is not None and abs(abs(origin) - HALF) > 1e-9:
            parallels = (origin,)  # texts of this kind give the latitude of true scale as the origin's
        origin = -HALF if south else HALF
    if method == "sphere mercator":
        method, flattening, parallels, scale = "mercator", 0.0, (), 1.0
    if method == "conic" and origin is None:
        origin = parallels[0] if parallels else 0.0
    return System(method, radius, flattening, meridian, origin or 0.0, parallels, scale, east, north, unit_)


def between(source: str, target: str):
    """A function of two columns: points of one system (its text) in the other."""
    a, b = system_of(source), system_of(target)
    return lambda x, y: b.forward(*a.inverse(x, y))
