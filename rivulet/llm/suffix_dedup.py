"""Suffix-array deduplication: remove every byte covered by a long string that also starts earlier in the corpus.

Method: blockwise suffix sorting with difference covers. Let ``length`` be the shortest string that counts. A position
is sampled if its residue modulo a period lies in a difference cover, so any two positions have a common shift, below
the period, at which both are sampled.

1. Documents are packed, in document order, into compressed blocks that are written to the checkpoint folder.
2. A wide cover over all text rules out suffixes that tie with none. Two equal strings of ``length`` bytes are both
   sampled at some shift and still agree on ``length - period + 1`` bytes there. The sampled suffixes of each block are cut
   to these bytes, fingerprinted and dealt by fingerprint bucket; one bucket is sorted at a time, and samples that no
   other block shares are unique. Only suffixes with a shared sample inside their window can tie for ``length`` bytes.
3. Within a block, suffixes near repeated samples are sorted, and all but the first of equal ones are found there.
4. The rest is dealt by suffix bucket, as short stretches of text: all suffixes of a stretch share their smallest inner
   fingerprint, which is their bucket. The bytes of each such fingerprint are counted first: suffixes of a frequent one
   (of a line that many documents have among different neighbours) are dealt one by one, by the fingerprint of their
   first ``length`` bytes, which only equal strings share.
5. Each bucket's suffixes are sorted. Equal ones are neighbours, and all but the first of them by (doc_id, start) are
   reported to their block.
6. Blocks turn reported and local starts into byte spans.

Sorting (steps 3 and 5, ``suffix_order``): the suffixes at a narrow cover's positions of the block's or bucket's text get
their ranks first, by doubling, as deep as strings must agree. Then suffixes are sorted by their first eight bytes, and
longer ties are resolved by the ranks: each residue class is ordered by the rank at its next sampled position, and two classes
merge by the ranks at their common shift. Fingerprints only deal suffixes to buckets; order and equality are by bytes.

Within a block only the first of equal suffixes is sent anywhere, so a string of full length, however many rows have
it, costs a bucket at most one entry a block. Strings that only share a part of it are kept from meeting in one bucket by
the count, at the cost of ``length`` bytes for each suffix of a frequent fingerprint. Memory is bounded by the block and
by the bucket; the numbers of both, and of tasks, grow with the input. Results are those of the input as given: overlaps
count.

Edge cases: null text is empty; an empty text has zero bytes and spans and the hash of no bytes; texts shorter than
``length`` keep all bytes; rows that repeat a doc_id are ordered among themselves by their place in the packed blocks;
other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import settle, small_batches

#: Periods and residues of perfect difference sets: fixed values.
COVERS = {7: (1, 2, 4), 13: (0, 1, 3, 9), 31: (1, 5, 11, 24, 25, 27), 57: (0, 1, 3, 13, 32, 36, 43, 52), 73: (0, 1, 3, 7, 15, 31, 36, 54, 63)}

BLOCK_BYTES = 2 << 20  # of text in a packed block, and in a slice of a longer text
NARROW = 7  # period of the cover whose ranks order the suffixes of a block or bucket
BUCKET_KEYS = 1 << 19  # sampled suffixes in a bucket, about
BUCKET_BYTES = 3 << 20  # of dealt text in a bucket, about
TASK_BYTES = 16 << 20  # of the corpus for each task of a shuffle, about
HOT = 4  # buckets' worth of dealt text that makes a smallest fingerprint a frequent one

ROOT = np.uint64(0x9E3779B97F4A7C15)
UNROOT = np.uint64(pow(int(ROOT), -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)


def cover_for(length: int) -> int:
    """The largest period that leaves at least two fifths of the string to the samples' prefixes (or the smallest period)."""
    return max([p for p in COVERS if length - p + 1 >= 0.4 * length] or [7])


@lru_cache(maxsize=1)
def _bytes_table() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (ROOT, UNROOT):
        p = np.full(n, base, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= MIX
    h ^= h >> np.uint64(29)
    h *= MIX
    h ^= h >> np.uint64(32)
    return h


class Grams:
    """Fingerprints of any byte string inside one buffer, from prefix sums."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        size = (n // (1 << 19) + 1) << 19
        up, self.down = _powers(size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_bytes_table()[buf] * up[:n], out=self.sums[1:])

    def at(self, idx: np.ndarray, length: int) -> np.ndarray:
        return _mixed((self.sums[idx + length] - self.sums[idx]) * self.down[idx])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - 1 - length + 1
        return _mixed((self.sums[length : length + n] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


def _near(hit: np.ndarray, n: int, reach: int) -> np.ndarray:
    """True at each p < n for which some hit lies in [p, p + reach)."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, np.maximum(hit - reach + 1, 0), 1)
    np.add.at(d, np.minimum(hit + 1, n), -1)
    return np.cumsum(d[:-1]) > 0


def _runs(flags: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of positions; a run also ends where ``breaks`` says that a new one begins."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.r_[True, np.diff(flags) != 1]
    if breaks is not None:
        first |= breaks
    at = np.flatnonzero(first)
    return flags[at], np.diff(np.r_[at, len(flags)])


def _same_text(buf: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Byte by byte, whether the strings at a and b agree."""
    view = np.lib.stride_tricks.sliding_window_view(buf, length)
    out = np.ones(len(a), bool)
    for k in range(0, len(a), 1 << 16):
        s = slice(k, k + (1 << 16))
        out[s] = (view[a[s]] == view[b[s]]).all(axis=1)
    return out


def cover_ranks(buf: np.ndarray, words: np.ndarray, depth: int, period: int = NARROW) -> np.ndarray:
    """For each position of a difference cover the rank of its suffix among them, from 1; 0 for the end and all others.

    Suffixes are sorted by eight bytes, and tied groups by the ranks a period further on, then twice as far, and so on,
    until they differ or agree on at least ``depth`` bytes; these have one rank.
    """
    n = len(buf)
    residue = np.zeros(period, bool)
    residue[list(COVERS[period])] = True
    sample = np.flatnonzero(np.resize(residue, n))
    ranks = np.zeros(n + 1, np.int32)
    first = words[sample]
    order = np.argsort(first)
    sample, first = sample[order], first[order]
    new = np.r_[True, first[1:] != first[:-1]] if len(first) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    ranks[sample] = (at + 1)[np.cumsum(new) - 1]
    tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
    shift = period
    while len(tied) and shift < depth:
        p = sample[tied]
        q = p + shift
        # Of suffixes that reach the end the shorter one, which goes further beyond it, is less.
        further = np.where(q < n, ranks[np.minimum(q, n)] + n, np.maximum(2 * n - q, 0))
        key = ranks[p].astype(np.int64) * (2 * n + 2) + further
        order = np.argsort(key)
        p, key = p[order], key[order]
        sample[tied] = p  # groups keep their places
        new = np.r_[True, key[1:] != key[:-1]]
        ranks[p] = (tied[new] + 1)[np.cumsum(new) - 1]
        tied = tied[~(new & np.r_[new[1:], True])]
        shift *= 2
    return ranks


def suffix_order(buf: np.ndarray, where: np.ndarray, depth: int, period: int = NARROW) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes at ``where``, as places in it, and whether each begins like the one before (eight bytes).

    Suffixes that agree on ``depth`` bytes are neighbours, in any order. At least ``period`` bytes must follow each
    position.
    """
    n = len(buf)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = buf
    words = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(np.uint64)
    first = words[where]
    order = np.argsort(first)
    first = first[order]
    new = np.r_[True, first[1:] != first[:-1]] if len(first) else np.zeros(0, bool)
    tied = np.flatnonzero(~(new & np.r_[new[1:], True])) if len(first) else np.zeros(0, np.int64)
    if not len(tied):
        return order, ~new
    ranks = cover_ranks(buf, words, depth, period)
    del words, first
    cover = set(COVERS[period])
    places = order[tied]
    at, group = where[places], np.cumsum(new)[tied] * (n + 2)
    residue = at % period
    own: list[np.ndarray] = []  # places in ``order`` of each residue class, in its order
    keys: list[dict[int, np.ndarray]] = []  # of each class, by shift
    for r in range(period):
        mine = np.flatnonzero(residue == r)
        shift = next(d for d in range(period) if (r + d) % period in cover)
        mine = mine[np.argsort(group[mine] + ranks[at[mine] + shift])]
        here, base = at[mine], group[mine]
        own.append(places[mine])
        keys.append({d: base + ranks[here + d] for d in range(period) if (r + d) % period in cover})
    to = [np.arange(len(c)) for c in own]
    for r in range(period):
        for q in range(r):
            shift = next(d for d in keys[r] if d in keys[q])
            less = np.searchsorted(keys[q][shift], keys[r][shift])
            to[r] += less
            to[q] += np.cumsum(np.bincount(less, minlength=len(own[q]) + 1))[: len(own[q])]
    # Suffixes that agree on ``depth`` bytes may have got one place; any order among them will do.
    order[tied] = np.concatenate(own)[np.argsort(np.concatenate(to), kind="stable")]
    return order, ~new


def _later(pieces: list[bytes], n: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """For each start in stretches of text (``n`` starts each, every one with ``length`` bytes to go), whether its first
    ``length`` bytes begin at a lower start too. Starts are ordered by their stretch's rank, then by place.

    Of equal stretches only the first is sorted: each start in the others has one before it.
    """
    seen: set[bytes] = set()
    first = np.ones(len(pieces), bool)
    for k in np.argsort(rank, kind="stable").tolist():
        first[k] = pieces[k] not in seen
        seen.add(pieces[k])
    out = np.repeat(~first, n)
    some = np.flatnonzero(first)
    buf = np.frombuffer(b"".join([pieces[k] for k in some.tolist()]), np.uint8)
    m = n[some]
    begin = np.cumsum(m + length - 1) - (m + length - 1)
    owner = np.repeat(np.arange(len(m)), m)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(m) - m, m)
    where = begin[owner] + step
    order, like = suffix_order(buf, where, length)
    again = np.flatnonzero(like)
    same = np.zeros(len(where), bool)
    same[again] = _same_text(buf, where[order[again]], where[order[again - 1]], length)
    if same.any():
        at = np.flatnonzero(~same)
        own = (rank[some][owner] * (int(m.max()) + 1) + step)[order]
        later = np.zeros(len(where), bool)
        later[order] = own != np.minimum.reduceat(own, at)[np.cumsum(~same) - 1]
        out[np.repeat(first, n)] = later
    return out


class Slice:
    """A part of a block: the buffer, and for each position its document's number and place in it."""

    def __init__(self, number: int, parts: list[tuple[int, int, bytes]], length: int, period: int):
        self.number, self.length, self.period = number, length, period
        self.sizes = np.array([len(p[2]) for p in parts], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.doc = np.array([p[0] for p in parts], np.int64)
        self.offset = np.array([p[1] for p in parts], np.int64)
        self.buf = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
        self.part = np.repeat(np.arange(len(parts)), self.sizes)

    @cached_property
    def grams(self) -> Grams:
        return Grams(self.buf)

    def sample(self) -> None:
        """Sets ``samples``, the wide cover's positions, their fingerprints ``keys``, and ``whole``, where a string of
        full length begins."""
        at = np.arange(len(self.buf)) - self.begins[self.part]
        left = self.sizes[self.part] - at
        self.whole = left >= self.length
        prefix = self.length - self.period + 1
        residue = np.zeros(self.period, bool)
        residue[list(COVERS[self.period])] = True
        self.samples = np.flatnonzero(residue[(at + self.offset[self.part]) % self.period] & (left >= prefix))
        self.keys = self.grams.at(self.samples, prefix)

    def sorted_keys(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct cut fingerprints, the number of each sample's, and how many samples have it."""
        self.sample()
        cut = self.keys >> np.uint64(32 - bits)
        return np.unique(cut, return_inverse=True, return_counts=True)[0:3]

    def locally_later(self, inverse: np.ndarray, counts: np.ndarray) -> np.ndarray:
        near = _near(self.samples[counts[inverse] > 1], len(self.buf), self.period) & self.whole
        where = np.flatnonzero(near)
        p, n = _runs(where, np.r_[True, np.diff(self.part[where]) != 0])
        return where[_later(self.texts(p, n), n, p, self.length)] if len(p) else where

    def texts(self, p: np.ndarray, n: np.ndarray) -> list[bytes]:
        """The bytes that runs of starts reach."""
        data = self.buf.tobytes()
        return [data[x : x + k + self.length - 1] for x, k in zip(p.tolist(), n.tolist(), strict=True)]

    def rows(self, p: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Runs of positions as (document's number, place in it, length)."""
        part = self.part[p]
        return np.stack([self.doc[part], p - self.begins[part] + self.offset[part], n]).astype(np.int64)


def _slices(ids: bytes, sizes: bytes, blob: bytes, length: int, period: int) -> Iterator[Slice]:
    """A block's slices. Longer texts are cut so that each string of full length lies in exactly one slice."""
    sizes_ = np.frombuffer(sizes, np.int64)
    text = zstandard.ZstdDecompressor().decompress(blob, max_output_size=int(sizes_.sum()) + 1) if sizes_.sum() else b""
    parts: list[tuple[int, int, bytes]] = []
    held = number = 0
    at = 0
    for k, n in enumerate(sizes_.tolist()):
        for off in range(0, max(n, 1), BLOCK_BYTES):
            piece = text[at + off : at + min(n, off + BLOCK_BYTES + length - 1)]
            if len(piece) >= length:
                parts.append((k, off, piece))
                held += len(piece)
            if held >= BLOCK_BYTES:
                yield Slice(number, parts, length, period)
                parts, held, number = [], 0, number + 1
        at += n
    if parts:
        yield Slice(number, parts, length, period)


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, count = TaskContext.get().partitionId(), 0
    docs: list[tuple[int, bytes]] = []
    held = 0

    def row() -> pd.DataFrame:
        docs.sort(key=lambda d: d[0])
        data = {
            "block": [(part << 32) | count],
            "ids": [np.array([d[0] for d in docs], np.int64).tobytes()],
            "sizes": [np.array([len(d[1]) for d in docs], np.int64).tobytes()],
            "n_bytes": [held],
            "blob": [zstandard.ZstdCompressor(level=6).compress(b"".join(d[1] for d in docs))],
        }
        return pd.DataFrame(data)

    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
            data = text.encode() if isinstance(text, str) else b""
            docs.append((doc_id, data))
            held += len(data)
            if held >= BLOCK_BYTES:
                yield row()
                docs, held, count = [], 0, count + 1
    if docs:
        yield row()


def _suffix_keys(bits: int, length: int, period: int):
    """For each slice its sampled suffixes by bucket; buckets without any have no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                for s in _slices(r.ids, r.sizes, r.blob, length, period):
                    keys = s.sorted_keys(bits)[0]
                    if not len(keys):
                        continue
                    buckets, cuts = np.unique(keys >> np.uint64(32), return_index=True)
                    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    parts = [low[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(low)], strict=True)]
                    yield pd.DataFrame({"bucket": buckets.astype(np.int32), "block": r.block, "slice": s.number, "keys": parts})

    return run


def _tied_across(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: sort its sampled suffixes; mark, for each slice, those that another slice has too."""
    parts = [np.frombuffer(k, np.uint32) for k in pdf["keys"]]
    keys = np.concatenate(parts)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    tied = np.zeros(len(keys), bool)
    tied[order] = np.r_[same, False] | np.r_[False, same] if len(k) else False
    ends = np.cumsum([len(p) for p in parts])
    marks = [np.packbits(tied[e - len(p) : e]).tobytes() for e, p in zip(ends, parts, strict=True)]
    some = [bool(tied[e - len(p) : e].any()) for e, p in zip(ends, parts, strict=True)]
    return pdf[["block", "slice", "bucket"]].assign(marks=marks)[some]


def _runs_as_bytes(p: np.ndarray, n: np.ndarray, low: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(x.astype("<u4").tobytes() for x in (np.diff(p, prepend=0), n, low)))


def _runs_from_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    p, n, low = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4").reshape(3, -1).astype(np.int64)
    return np.cumsum(p), n, low.astype(np.uint64)


def _found(bits: int, length: int, period: int):
    """For each slice of a block: its own later starts, and the starts that other blocks may share, in runs that have one
    smallest inner fingerprint each: first positions, lengths and the fingerprints' upper halves."""
    inner = max(4, length // 5)

    def run(key: tuple, blocks: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        by_slice = dict(tuple(marks.groupby("slice")))
        for r in blocks.itertuples():
            for s in _slices(r.ids, r.sizes, r.blob, length, period):
                keys, inverse, counts = s.sorted_keys(bits)
                later = s.locally_later(inverse, counts)
                p, n = _runs(later, np.r_[True, np.diff(s.part[later]) != 0])
                mine, runs, size = s.rows(p, n).tobytes(), b"", 0
                if s.number in by_slice:
                    bounds = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32)) if bits < 16 else None
                    tied = np.zeros(len(keys), bool)
                    for m in by_slice[s.number].itertuples():
                        a, b = (bounds[m.bucket], bounds[m.bucket + 1]) if bounds is not None else np.searchsorted(keys, np.array([m.bucket, m.bucket + 1], np.uint64) << np.uint64(32))
                        tied[a:b] = np.unpackbits(np.frombuffer(m.marks, np.uint8), count=b - a).astype(bool)
                    open_ = _near(s.samples[tied[inverse]], len(s.buf), period) & s.whole
                    open_[later] = False
                    at = np.flatnonzero(open_)
                    if len(at):
                        low = s.grams.all(inner)
                        width = 1
                        while width < length - inner + 1:  # the smallest fingerprint inside each string, by doubling
                            step = min(width, length - inner + 1 - width)
                            low = np.minimum(low[:-step], low[step:])
                            width += step
                        least = low[at]
                        p, n = _runs(at, np.r_[True, (least[1:] != least[:-1]) | (np.diff(s.part[at]) != 0)])
                        runs, size = _runs_as_bytes(p, n, _mixed(low[p]) >> np.uint64(32)), int((n + length - 1).sum())
                if len(mine) or size:
                    out.append((r.block, s.number, mine, runs, size))
        return pd.DataFrame(out, columns=["block", "slice", "starts", "runs", "dealt"])

    return run


def _counted(length: int, least: float):
    """For each slice: bytes and starts to deal for each smallest fingerprint that has at least so many bytes in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data in pdf["runs"]:
                _, n, low = _runs_from_bytes(data)
                values, inverse = np.unique(low, return_inverse=True)
                starts = np.bincount(inverse, n, len(values)).astype(np.int64)
                held = np.bincount(inverse, n + length - 1, len(values)).astype(np.int64)
                some = held >= least
                yield pd.DataFrame({"low": values[some].astype(np.int64), "bytes": held[some], "starts": starts[some]})

    return run


def _stretches(buckets: int, length: int, period: int, hot: np.ndarray):
    """For each block: stretches of text with the starts that other blocks may share. hot: frequent fingerprints, sorted."""

    def run(key: tuple, blocks: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        by_slice = dict(zip(found["slice"], found["runs"], strict=True))
        for r in blocks.itertuples():
            ids = np.frombuffer(r.ids, np.int64)
            for s in _slices(r.ids, r.sizes, r.blob, length, period):
                if not by_slice.get(s.number):
                    continue
                p, n, to = _runs_from_bytes(by_slice[s.number])
                if len(hot):
                    frequent = hot[np.minimum(np.searchsorted(hot, to), len(hot) - 1)] == to
                    fp, fn = p[frequent], n[frequent]
                    one = np.repeat(fp, fn) + np.arange(fn.sum()) - np.repeat(np.cumsum(fn) - fn, fn)
                    p, n = np.r_[p[~frequent], one], np.r_[n[~frequent], np.ones(len(one), np.int64)]
                    to = np.r_[to[~frequent], s.grams.at(one, length)]
                to = (_mixed(to) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                p, n, to = p[order], n[order], to[order]
                rows = np.concatenate([ids[s.doc[s.part[p]]][None, :], s.rows(p, n)])
                cuts, texts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]), s.texts(p, n)
                for a, b in zip(cuts, [*cuts[1:], len(to)], strict=True):
                    out.append((int(to[a]), r.block, rows[:, a:b].tobytes(), zstandard.ZstdCompressor(level=3).compress(b"".join(texts[a:b]))))
        return pd.DataFrame(out, columns=["bucket", "block", "starts", "texts"])

    return run


def _later_across(length: int):
    """One bucket: sort its suffixes; report the starts that are not the first of their class."""

    def run(dealt: pd.DataFrame) -> pd.DataFrame:
        counts = [len(s) // 32 for s in dealt["starts"]]
        rows = np.concatenate([np.frombuffer(s, np.int64).reshape(4, -1) for s in dealt["starts"]], axis=1)
        block = np.repeat(dealt["block"].to_numpy(), counts)
        un = zstandard.ZstdDecompressor()
        text = b"".join(un.decompress(t) for t in dealt["texts"])
        doc_id, doc, start, n = rows
        ends = np.cumsum(n + length - 1).tolist()
        pieces = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        owner = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        place = np.lexsort((start, doc, block, doc_id))  # stretches of one document do not overlap in their starts
        rank = np.empty(len(n), np.int64)
        rank[place] = np.arange(len(n))
        hit = np.flatnonzero(_later(pieces, n, rank, length))
        if not len(hit):
            return pd.DataFrame({"block": block[:0], "starts": []})
        first = np.r_[True, (np.diff(hit) != 1) | (owner[hit[1:]] != owner[hit[:-1]])]
        at = np.flatnonzero(first)
        run_n = np.diff(np.r_[at, len(hit)])
        o = owner[hit[at]]
        order = np.argsort(block[o], kind="stable")
        o, run_n, first_step = o[order], run_n[order], step[hit[at]][order]
        res = np.stack([doc[o], start[o] + first_step, run_n])
        cuts = np.flatnonzero(np.r_[True, block[o][1:] != block[o][:-1]])
        out = [(block[o[a]], res[:, a:b].tobytes()) for a, b in zip(cuts, [*cuts[1:], len(o)], strict=True)]
        return pd.DataFrame(out, columns=["block", "starts"])

    return run


def _cut(length: int, keep_text: bool):
    """Blocks with all their later starts: spans, counts and what is left of each document."""

    def run(key: tuple, blocks: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        found = np.concatenate([np.zeros((3, 0), np.int64), *[np.frombuffer(s, np.int64).reshape(3, -1) for s in starts["starts"]]], axis=1)
        found = found[:, np.lexsort((found[1], found[0]))]
        for r in blocks.itertuples():
            ids, sizes = np.frombuffer(r.ids, np.int64), np.frombuffer(r.sizes, np.int64)
            text = zstandard.ZstdDecompressor().decompress(r.blob, max_output_size=int(sizes.sum()) + 1) if sizes.sum() else b""
            at = 0
            bounds = np.searchsorted(found[0], np.arange(len(ids) + 1))
            for k, (doc_id, n) in enumerate(zip(ids.tolist(), sizes.tolist(), strict=True)):
                mine = found[:, bounds[k] : bounds[k + 1]]
                spans: list[list[int]] = []
                for a, m in zip(mine[1].tolist(), mine[2].tolist(), strict=True):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], a + m + length - 1)
                    else:
                        spans.append([a, a + m + length - 1])
                left, last = [], 0
                for a, b in spans:
                    left.append(text[at + last : at + a])
                    last = b
                left.append(text[at + last : at + n])
                kept = b"".join(left)
                row = (doc_id, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                out.append((*row, ",".join(f"{a}:{b}" for a, b in spans), kept) if keep_text else row)
                at += n
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["spans", "kept"] if keep_text else [])])

    return run


def _blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """The packed blocks, and how many bytes of text they hold."""
    small_batches(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = settle(read.mapInPandas(_pack, "block long, ids binary, sizes binary, n_bytes long, blob binary"))
    return blocks, blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]


def _dealt(blocks: DataFrame, total: int, tasks: int, length: int) -> tuple[DataFrame, DataFrame, int]:
    """What each slice of a block found by itself, the stretches that blocks send to the buckets, and how many these are."""
    period = cover_for(length)
    sampled = total * len(COVERS[period]) // period
    bits = max(3, (sampled // BUCKET_KEYS).bit_length())
    if bits > 31:
        raise ValueError("more suffix buckets than a block can address")
    by_block = blocks.repartition(tasks, "block").groupBy("block")

    keys = blocks.mapInPandas(_suffix_keys(bits, length, period), "bucket int, block long, slice int, keys binary")
    marks = keys.repartition(tasks, "bucket").groupBy("bucket").applyInPandas(_tied_across, "block long, slice int, bucket int, marks binary")
    found = by_block.cogroup(marks.repartition(tasks, "block").groupBy("block"))
    found = settle(found.applyInPandas(_found(bits, length, period), "block long, slice int, starts binary, runs binary, dealt long"))

    about = found.agg(F.count(F.lit(1)).alias("slices"), F.coalesce(F.sum("dealt"), F.lit(0)).alias("dealt")).first()
    # Of a fingerprint with HOT buckets' worth, slices with less than half an equal share hold less than half.
    many = HOT * BUCKET_BYTES / 2
    runs = found.where("dealt > 0").select("block", "slice", "runs")
    counts = runs.select("runs").mapInPandas(_counted(length, many / max(1, about["slices"])), "low long, bytes long, starts long")
    # At most dealt / many rows: one for each fingerprint with several buckets' worth of text.
    frequent = counts.groupBy("low").agg(F.sum("bytes").alias("bytes"), F.sum("starts").alias("starts")).where(F.col("bytes") >= many).collect()
    hot = np.sort(np.array([r.low for r in frequent], np.int64)).astype(np.uint64)
    buckets = max(8, (about["dealt"] + length * sum(r.starts for r in frequent)) // BUCKET_BYTES)

    dealt = by_block.cogroup(runs.repartition(tasks, "block").groupBy("block"))
    dealt = dealt.applyInPandas(_stretches(buckets, length, period, hot), "bucket long, block long, starts binary, texts binary")
    return found, dealt, buckets


def dedup_substrings(docs: DataFrame, length: int = 100, keep_text: bool = False) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256.

    keep_text adds ``spans`` ("start:end" in bytes, comma-joined) and ``kept``, the bytes that are left.
    """
    blocks, total = _blocks(docs)
    tasks = max(8, total // TASK_BYTES)
    found, dealt, buckets = _dealt(blocks, total, tasks, length)
    across = dealt.repartition(max(tasks, buckets // 4), "bucket").groupBy("bucket").applyInPandas(_later_across(length), "block long, starts binary")
    starts = across.unionByName(found.where(F.length("starts") > 0).select("block", "starts")).repartition(tasks, "block")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", spans string, kept binary" if keep_text else "")
    return blocks.repartition(tasks, "block").groupBy("block").cogroup(starts.groupBy("block")).applyInPandas(_cut(length, keep_text), schema)
