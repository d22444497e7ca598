"""Secret scan in DataFrame functions only: fixed patterns, and sliding-window entropy over candidate strings.

Base kinds are leftmost non-overlapping matches of a pattern, with a least length: ``assign`` (a key word, a sign and
a value), ``access`` (access key ids) and ``hex`` (long lower-case hex runs). Beyond these the method looks at candidate
strings, runs of characters that keys are made of. A window of fixed width slides over each candidate; the counts of
its characters change by one in and one out, and with them the sum of c * log2(c), so the Shannon entropy of each
window costs no recount. Thresholds hold per character class (hex digits, or the base-64 alphabet). Windows above the
threshold give a span from the first to the last of them; the allow-list suppresses strings that are no secrets, such
as plain words, plain numbers and UUIDs. It never suppresses a base span.

Positions are code points: a text is split at a pattern's matches, and the lengths of gaps and matches add up to the
starts. Sums over a text's matches are made in chunks of about the square root of their number, so a text with very
many matches costs little more than their number. A window's counts are packed twelve to a number. All work is per row;
nothing is shuffled.

Edge cases: null text counts as empty and has no spans; empty texts have none; spans of different kinds may overlap;
repeated rows give repeated rows; every input column but doc_id and text is ignored by ``scan``, while ``redact`` keeps
them all, whatever their names, and changes text and n_chars only.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import fresh

#: The base patterns (kind, pattern, least length, group whose length counts) in their order.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]{24,}+", 24, 0),
)
#: Texts without any of these strings (in lower case for assign) can't match; a cheap test before the pattern.
NEEDS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("AKIA",)}

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: Kind, what the whole candidate must match, alphabet, least entropy of a window in bits.
CLASSES = (
    ("entropy_hex", r"^[0-9A-Fa-f]+$", "0123456789abcdef", 3.0),
    ("entropy_base64", r"^[A-Za-z0-9+/_=-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.85),
)
#: Candidates that match one of these are no secrets: words and lists of words, numbers, UUIDs, samples, rules.
ALLOW = (
    r"^[A-Za-z/_=-]+$",
    r"^[0-9/_=+-]+$",
    r"^[A-Za-z]+[0-9]{1,4}$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|placeholder|xxxx|changeme",
)
WINDOW = 20
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"
PER_NUMBER, BITS = 12, 5  # counts in a long, and bits of each: a window holds less than 32 characters
NO_INTS = "array<int>"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once; lambdas would compute a repeated expression for each element."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array of whole numbers the op over those before it, 0 for the first."""
    zero = F.struct(F.lit(0).alias("acc"), F.array().cast(NO_INTS).alias("out"))

    def grown(a: Column, x: Column) -> Column:
        return F.struct(op(a["acc"], x).alias("acc"), F.concat(a["out"], F.array(a["acc"])).alias("out"))

    def chunked(v: Column) -> Column:
        return _let(F.ceil(F.sqrt(F.size(v))).cast("int"), lambda c: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / c).cast("int")), lambda k: F.slice(v, k * c + 1, c)))

    def joined(parts: Column) -> Column:
        bases = F.aggregate(parts, zero, lambda a, p: grown(a, p["acc"]), lambda a: a["out"])
        return F.flatten(F.zip_with(parts, bases, lambda p, b: F.transform(p["out"], lambda x: op(x, b))))

    whole = _let(values, lambda v: F.when(F.size(v) > 0, _let(F.transform(chunked(v), lambda c: F.aggregate(c, zero, grown)), joined)).otherwise(F.array().cast(NO_INTS)))
    return whole


def _matches(text: Column, pattern: str) -> Column:
    """All matches as (start, m), code points from 0."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(F.split(text, pattern, -1), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("n"), m.alias("m")))

    def placed(items: Column) -> Column:
        ends = _running(F.transform(items, lambda x: x["gap"] + x["n"]), lambda a, b: a + b)
        return F.zip_with(items, ends, lambda x, at: F.struct((at + x["gap"]).alias("start"), x["m"].alias("m")))

    return _let(F.filter(both, lambda x: x["m"].isNotNull()), placed)


def _base_spans(text: Column, rank: int) -> Column:
    kind, pattern, least, group = BASE[rank]
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    found = F.zip_with(_matches(text, pattern), values, lambda f, v: F.struct(f["start"].alias("start"), (f["start"] + F.length(f["m"])).alias("end"), F.length(v).alias("n")))
    spans = F.transform(F.filter(found, lambda z: z["n"] >= least), lambda z: F.struct(z["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), z["end"].alias("end")))
    test = text.rlike(pattern)
    needs = NEEDS.get(kind)
    if needs:
        low = F.lower(text) if kind == "assign" else text
        test = reduce(lambda a, b: a | b, [low.contains(n) for n in needs]) & test
    return F.when(test, spans).otherwise(F.array().cast(SPAN))


def _entropy_range(candidate: Column, alphabet: str, least: float, fold: bool) -> Column:
    """The first start and the last end (from 0) of the candidate's windows with enough entropy; end 0: none.

    State: counts of the window's characters and f, their sum of c * log2(c); entropy = log2(W) - f / W. Each step
    takes one character in and one out.
    """
    w = WINDOW
    g = F.array(*[F.lit(x * math.log2(x) if x else 0.0) for x in range(w + 2)])
    most = (math.log2(w) - least) * w
    number = lambda x: F.floor((x - 1) / PER_NUMBER).cast("int")
    bits = lambda x: ((x - 1) % PER_NUMBER * BITS).cast("int")
    one = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), bits(x))
    count = lambda c, x: F.call_function("shiftright", c[number(x)], bits(x)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    symbols = F.transform(F.split(F.lower(candidate) if fold else candidate, ""), lambda c: F.instr(F.lit(alphabet), c))
    moves = _let(symbols, lambda s: F.slice(F.zip_with(s, F.concat(F.array_repeat(F.lit(0), w), s), lambda x, y: F.struct(x.alias("x"), y.alias("y"))), F.lit(1), F.size(s)))

    def step(a: Column, p: Column) -> Column:
        x, y, c = p["x"], p["y"], a["c"]
        out = F.when(y > 0, _let(count(c, y), lambda n: g[n] - g[n - 1])).otherwise(F.lit(0.0))
        into = _let(count(c, x) - F.when(x == y, 1).otherwise(0), lambda n: g[n + 1] - g[n])
        counts = F.transform(c, lambda v, k: v + F.when(k == number(x), one(x)).otherwise(F.lit(0).cast("long")) - F.when((y > 0) & (k == number(y)), one(y)).otherwise(F.lit(0).cast("long")))

        def state(f: Column) -> Column:
            i = a["i"] + 1
            hit = (i >= w) & (f <= most)
            return F.struct(i.alias("i"), counts.alias("c"), f.alias("f"), F.when(hit & (a["lo"] < 0), i - w).otherwise(a["lo"]).alias("lo"), F.when(hit, i).otherwise(a["hi"]).alias("hi"))

        return _let(a["f"] - out + into, state)

    numbers = -(-len(alphabet) // PER_NUMBER)
    zero = F.struct(F.lit(0).alias("i"), F.array_repeat(F.lit(0).cast("long"), numbers).alias("c"), F.lit(0.0).alias("f"), F.lit(-1).alias("lo"), F.lit(0).alias("hi"))
    return F.aggregate(moves, zero, step, lambda a: F.struct(a["lo"].alias("lo"), a["hi"].alias("hi")))


def _entropy_spans(text: Column) -> Column:
    """Spans of candidates whose windows have enough entropy."""

    def of(candidates: Column) -> Column:
        parts = []
        allowed = lambda m: reduce(lambda a, b: a | b, [m.rlike(p) for p in ALLOW])
        for rank, (kind, whole, alphabet, least) in enumerate(CLASSES, len(BASE)):
            earlier = [c[1] for c in CLASSES[: rank - len(BASE)]]
            mine = F.filter(candidates, lambda x: reduce(lambda a, b: a & b, [x["m"].rlike(whole), *[~x["m"].rlike(e) for e in earlier], ~allowed(x["m"])]))  # noqa: B023
            ranges = F.transform(mine, lambda x: F.struct(x["start"].alias("start"), _entropy_range(x["m"], alphabet, least, kind == "entropy_hex").alias("w")))  # noqa: B023
            some = F.filter(ranges, lambda r: r["w"]["hi"] > 0)
            parts.append(F.transform(some, lambda r: F.struct((r["start"] + r["w"]["lo"]).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (r["start"] + r["w"]["hi"]).alias("end"))))  # noqa: B023
        return F.concat(*parts)

    return F.when(text.rlike(CANDIDATE), _let(_matches(text, CANDIDATE), of)).otherwise(F.array().cast(SPAN))


def find_spans(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """Adds ``into``: all spans (start, rank, kind, end), by start, then kind in the listed order."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumn(into, F.array_sort(F.concat(*[_base_spans(t, k) for k in range(len(BASE))], _entropy_spans(t))))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row a document: counts of the base kinds, ``base_sha256`` over the base spans, and all ``spans``."""
    d = find_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "found")
    count = lambda rank: F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long")
    return d.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, (kind, *_) in enumerate(BASE)],
        F.size(F.filter("found", lambda s: s["rank"] >= len(BASE))).cast("long").alias("n_entropy"),
        F.sha2(_listed(F.filter("found", lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )


def _without(text: Column, spans: Column, mark: str) -> Column:
    """The text with each run of overlapping or touching spans replaced by ``mark``."""

    def gaps(all_: Column) -> Column:
        # A run of spans begins where none before reaches; what lies between is kept.
        before = _running(F.transform(all_, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        both = F.zip_with(all_, before, lambda s, e: F.struct(e.alias("a"), s["start"].alias("b")))
        return F.filter(F.transform(both, lambda x, i: F.struct(x["a"].alias("a"), x["b"].alias("b"), i.alias("i"))), lambda x: (x["i"] == 0) | (x["b"] > x["a"]))

    def kept(parts: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(parts))).cast("int")
        chunks = _let(size, lambda c: F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / c).cast("int")), lambda k: F.slice(parts, k * c + 1, c)))
        return F.array_join(F.transform(chunks, piece), "")

    def piece(chunk: Column) -> Column:
        # Positions are counted from the text's begin, so a chunk's part of the text is taken out first.
        base = F.element_at(chunk, 1)["a"]
        part = F.substring(text, base + 1, F.element_at(chunk, -1)["b"] - base)
        return _let(F.struct(part.alias("t"), base.alias("z"), chunk.alias("c")), lambda p: F.array_join(F.transform(p["c"], lambda x: F.concat(F.substring(p["t"], x["a"] - p["z"] + 1, x["b"] - x["a"]), F.lit(mark))), ""))

    rest = F.substring(text, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(text))
    return F.concat(_let(gaps(spans), kept), rest)


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """Replaces every span, overlapping ones as one, by ``mark``; all columns stay, n_chars follows the new text."""
    spans = fresh(docs, "spans")
    d = find_spans(docs, spans)
    text = F.when(F.size(spans) > 0, _without(F.col("text").cast("string"), F.col(spans), mark)).otherwise(F.col("text"))
    d = d.withColumn("text", text)
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns])
