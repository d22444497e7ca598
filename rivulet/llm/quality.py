"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

Grades are ordered: 0 toxic, 1 poor, 2 good. One set of weights over hashed features of a text gives its score s, and
ordered thresholds turn the score into P(grade > k) = sigmoid(s - threshold_k); their sum is the expected grade, and
the last of them, the tail probability of a good text, decides what stays. Features: the text's distinct words, their
first letters, the runs of signs in them, and a few whole-text measures in steps; a score is the sum over distinct
features. A feature enters by the smoothed log ratio of its rates among good and bad texts, and only if it speaks
against a text: no amount of ordinary words makes up for bad ones, however long the text is.

The model is fitted on a sample of labelled documents, bounded by ``sample`` (documents, taken in the order of a hash
of their id, so the same ones each time), and then scores all documents where they are; nothing is shuffled.

Edge cases: null text counts as empty; a text without words (null, empty, blank) is rejected outright, with tail
probabilities of 0; repeated rows get equal scores; label rows with null grades or without a document are skipped; repeated
label rows of one document count once; without any usable label every document is kept with a tail probability of 1; an
empty table gives an empty result; extra columns are ignored, and ``keep_good`` hands them on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import small_batches

BITS = 31
SAMPLE = 12_000
KEEP = 0.4
LEAST_SEEN = 3  # documents, and
LEAST_SHARE = 0.0015  # of the sample
PRIOR = 40  # documents at the overall rate that each grade's rates are smoothed with
LEAST_RATIO = 1.6
STEPS = 100
CACHED_WORDS = 150_000
PREFIX = 5
PLAIN = ".,;:!?'\"()-"

SIGNS = re.compile(r"[^\w\s]+|_+")


def _bucket(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature) & ((1 << BITS) - 1)


#: Weights by feature, and the thresholds.
Model = tuple[dict[int, float], np.ndarray]


class Features:
    """Distinct hashed features of texts, or those of them that ``wanted`` holds; a word's are looked up."""

    def __init__(self, wanted: dict[int, float] | None = None) -> None:
        self.wanted = wanted
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, w: str) -> tuple[int, ...]:
        low = w.lower().strip(PLAIN)
        f = [_bucket("w:" + low)] if low else []
        if len(low) > PREFIX:
            f.append(_bucket("p:" + low[:PREFIX]))
        if not w.isalnum():
            f += [_bucket("s:" + s[:3]) for s in set(SIGNS.findall(w)) if s not in PLAIN]
        return tuple(f) if self.wanted is None else tuple(x for x in f if x in self.wanted)

    def __call__(self, text: str | None) -> set[int]:
        words = text.split() if isinstance(text, str) else []
        distinct = set(words)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        out: set[int] = set()
        for w in distinct:
            f = known.get(w)
            if f is None:
                f = known[w] = self.of_word(w)
            if f:
                out.update(f)
        n = len(words)
        signs = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in PLAIN)
        upper = sum(1 for w in words if len(w) > 2 and w.isupper())
        measures = (f"words{min(n.bit_length(), 12)}", f"distinct{10 * len(distinct) // n if n else -1}", f"signs{10 * signs // n if n else -1}", f"upper{10 * upper // n if n else -1}")
        whole = {_bucket("t:" + x) for x in measures}
        return out | (whole if self.wanted is None else {x for x in whole if x in self.wanted})


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    features = Features()
    for pdf in batches:
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "grade": pdf["grade"], "features": [sorted(features(t)) for t in pdf["text"]]})


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, steps: int = STEPS, decay: float = 3e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, weights, thresholds) of the cumulative-link model, by Adam on the likelihood; thresholds stay in order."""
    levels = max(2, int(grades.max(initial=1)))
    n = len(rows)
    names, at = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int64), return_inverse=True)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    share = np.bincount(grades, minlength=levels + 1)
    seen = np.stack([np.bincount(at[grades[owner] == k], minlength=len(names)) for k in range(levels + 1)])
    all_seen = seen.sum(axis=0)
    rates = (seen + PRIOR * all_seen / n) / (share[:, None] + PRIOR)
    ratio = np.log(rates[levels] / rates[:levels]).min(axis=0)
    chosen = (ratio <= -LEAST_RATIO) & (all_seen >= max(LEAST_SEEN, LEAST_SHARE * n))
    number = np.cumsum(chosen) - 1
    keep = chosen[at]
    at, owner, names, ratio = number[at[keep]], owner[keep], names[chosen], ratio[chosen]
    x = ratio[at]
    # grades weigh more alike than they are frequent: a rare one would otherwise hardly move the shared weights
    by_row = np.sqrt(n / np.maximum(share, 1) / (share > 0).sum())[grades]
    by_row /= by_row.sum()
    start = 0.3
    w = np.full(len(names), start)
    theta = np.r_[-1.0, np.full(levels - 1, np.log(2.0))]  # the first threshold, then logs of the gaps
    m, v = np.zeros(len(w) + levels), np.zeros(len(w) + levels)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, steps + 1):
        cuts = np.r_[-np.inf, np.cumsum(np.r_[theta[:1], np.exp(theta[1:])]), np.inf]
        s = np.bincount(owner, weights=w[at] * x, minlength=n)
        hi, lo = sigmoid(cuts[grades + 1] - s), sigmoid(cuts[grades] - s)
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        to_score = by_row * (d_hi - d_lo)  # of the negative log-likelihood
        g = np.bincount(at, weights=to_score[owner] * x, minlength=len(w)) + decay * (w - start)
        by_cut = np.array([(by_row * (d_lo * (grades == k + 1) - d_hi * (grades == k))).sum() for k in range(levels)])
        tail = np.cumsum(by_cut[::-1])[::-1]
        g = np.r_[g, tail[0], tail[1:] * np.exp(theta[1:])]
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w = np.maximum(w - move[: len(w)], 0)
        theta -= move[len(w) :]
    return names, w * ratio, np.cumsum(np.r_[theta[:1], np.exp(theta[1:])])


def _fitted(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
    names, w, cuts = fit_ordinal([np.asarray(f) for f in pdf["features"]], pdf["grade"].to_numpy().astype(np.int64))
    return pd.DataFrame({"names": [names.astype(np.int32).tobytes()], "weights": [w.tobytes()], "cuts": [cuts.tolist()]})


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 of poor quality, 2 good; the lowest of a document's rows."""
    grade = F.when(F.col("toxic") == 1, 0).when((F.col("quality") == 0) & (F.col("toxic") == 0), 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade")).where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, grades: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model, fitted in one task on at most ``sample`` labelled documents; None without labels.

    The chosen ids are broadcast: at most ``sample`` pairs of numbers. The model has at most the features that
    LEAST_SHARE of the sample's documents hold.
    """
    small_batches(docs.sparkSession)
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", "text", "grade").mapInPandas(_featured, "doc_id long, grade int, features array<int>")
    model = rows.groupBy(F.lit("all").alias("all")).applyInPandas(_fitted, "names binary, weights binary, cuts array<double>").first()
    if model is None:
        return None
    names, weights = np.frombuffer(bytes(model["names"]), np.int32), np.frombuffer(bytes(model["weights"]), np.float64)
    return dict(zip(names.tolist(), weights.tolist(), strict=True)), np.array(model["cuts"])


def _scored(model: Model | None, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features(model[0] if model else {})
        for pdf in batches:
            if model is None:
                tails = np.ones((len(pdf), 2))
            else:
                weights, cuts = model
                s = np.array([sum(weights[f] for f in sorted(features(t))) for t in pdf["text"]], np.float64)
                tails = 1 / (1 + np.exp(-np.clip(s[:, None] - cuts[None, :], -40, 40)))
                tails[[not (isinstance(t, str) and t.split()) for t in pdf["text"]]] = 0  # without words nothing speaks for a text
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "expected_grade": tails.sum(axis=1), "p_good": tails[:, -1], "kept": tails[:, -1] >= KEEP})[columns]

    return run


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row a document: doc_id, expected_grade (0 to 2), p_good (tail probability) and kept."""
    model = fit(docs, graded(labels), sample)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    columns = ["doc_id", "expected_grade", "p_good", "kept"]
    return read.mapInPandas(_scored(model, columns), "doc_id long, expected_grade double, p_good double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier keeps; same columns."""
    model = fit(docs, graded(labels), sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scored(model, ["kept"])
        for batch in batches:
            texts = pd.DataFrame({"doc_id": 0, "text": batch.column("text").to_pylist()})
            yield batch.filter(pa.array(next(score(iter([texts])))["kept"].to_numpy(), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
