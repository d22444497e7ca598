"""Toxicity: a support vector machine with a gapped string kernel over Nyström landmarks, learned from labelled documents.

Kernel: two strings are alike by the subsequences of three characters that they share, each weighed by DECAY to its span
(from first to last character, at most SPAN), divided by a norm for the string's length. Subsequences have gaps, so a
word with a letter put in, or one with another ending, stays near the word; start and end count as characters.

Method: sentences are cut into pieces: words without their signs, single letters in a row ("i d i o t") as one word, very long
words in overlapping parts. A sentence is as toxic as its worst piece. Only documents are labelled, so pieces are learned from
bags: all pieces of clean documents are clean; of a toxic one those are toxic that the machine says are, and always the worst. It
begins with pieces whose subsequences are in more toxic than clean documents, and each round takes as counter-examples the
worst pieces of clean documents. Landmarks are pieces of both kinds; the kernel with them, times the inverse root of the kernel
among them, are a piece's features, and a linear machine with squared hinge loss is trained on these by Newton steps. As the kernel is
a product of subsequence weights, the landmarks' weights fold into one weight a subsequence, and a piece is scored by
adding these up. A document's score is a logistic function of its worst sentences' margins, fitted on sampled documents that
the machine was not trained on (a third, or by turns if the sample is small), with clean ones weighed as frequent as they are.

Labels are learned only from documents with crc32(doc_id) % 3 other than 1, at most SAMPLE_TOXIC and SAMPLE_CLEAN of them, taken in the
order of a hash of the id. Fitting is one task on this bounded sample; all documents are then scored where they are, each whole text.

Edge cases: null text is empty; a text without pieces gets the score of no evidence (0); repeated rows get equal scores;
label rows with null ids or labels are skipped, of several for a document the most toxic counts; without labels of both
kinds every score is 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import bounded_batches

SAMPLE_TOXIC = 2500
SAMPLE_CLEAN = 7500
THRESHOLD = 0.7
DECAY = 0.6
SPAN = 5
LANDMARKS = 512
ROUNDS = 6
SMALL_SAMPLE = 1500  # documents
SURPRISE = 10.0  # standard deviations that count
TRUSTED = 4.0  # of them, from which on a toxic piece has its full weight
NEWTON = 8  # steps
NEGATIVES = 20_000  # pieces of clean documents, besides the worst of each
PIECE = 30  # characters of a piece; longer words are cut
OVERLAP = 10
KNOWN_WORDS = 200_000
TOP = 3  # sentences that a document's score looks at
NONE = -3.0  # margin where there is no sentence

SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
SIGNS = re.compile(r"[\W_]+")
SPACED = re.compile(r"(?<!\S)\w(?:[ \t]\w){2,}(?!\S)")
MAYBE_SPACED = re.compile(r"\s\w\s\w\s\w\s|^\w\s\w\s\w\b")
FIRST, LAST, CODES = 62, 63, 64

#: Distances from the first to the second and third character of a subsequence.
STEPS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


def _codes(text: str) -> np.ndarray:
    """Letters and digits have a code each, other characters share the rest."""
    n = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    other = 37 + (n * 2654435761 >> 7) % 25
    return np.where((n >= 97) & (n <= 122), n - 96, np.where((n >= 48) & (n <= 57), n - 21, other)).astype(np.int32)


def pieces(word: str) -> list[str]:
    """A word without its signs, in lower case; a long one in parts that overlap."""
    w = SIGNS.sub("", word.lower())
    if len(w) <= PIECE:
        return [w] if w else []
    return [w[k : k + PIECE] for k in range(0, len(w) - OVERLAP, PIECE - OVERLAP)]


def sentences(text: str | None) -> list[list[str]]:
    """The words of each sentence."""
    if not isinstance(text, str):
        return []
    if MAYBE_SPACED.search(text):
        text = SPACED.sub(lambda m: "".join(m[0].split()), text)
    return [w for s in SENTENCE.split(text) if (w := s.split())]


def _subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each way to step: the pieces' numbers, the subsequences' codes, and their weight; pieces have their norm in ``_norms``."""
    size = np.array([len(w) + 2 for w in words])
    chars = np.zeros((len(words), int(size.max(initial=2)) + SPAN), np.int32)
    inner = _codes("".join(words))
    chars[:, 0] = FIRST
    row = np.repeat(np.arange(len(words)), size - 2)
    chars[row, np.arange(len(row)) - np.repeat(np.cumsum(size - 2) - (size - 2), size - 2) + 1] = inner
    chars[np.arange(len(words)), size - 1] = LAST
    place = np.arange(chars.shape[1])
    flat, width = chars.ravel(), chars.shape[1]
    for last in range(2, SPAN):
        at = np.flatnonzero(place[None, :] + last < size[:, None])
        who, ends = at // width, flat[at] * (CODES * CODES) + flat[at + last]
        for j, k in STEPS:
            if k == last:
                yield who, ends + flat[at + j] * CODES, DECAY ** (k - 2)


def _norms(words: list[str]) -> np.ndarray:
    """Root of the sum of squared weights over all subsequences of a piece; depends on its length alone."""
    size = np.array([len(w) + 2 for w in words])
    return np.sqrt(sum(np.maximum(size - k, 0) * DECAY ** (2 * (k - 2)) for _, k in STEPS) + 1e-9)


def _margins(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.zeros(len(words))
    for a in range(0, len(words), 4096):
        part = words[a : a + 4096]
        total = np.zeros(len(part))
        for who, code, weight in _subsequences(part):
            total += weight * np.bincount(who, weights[code], len(part))
        out[a : a + 4096] = total / _norms(part)
    return out + bias


@dataclass
class Model:
    """``weights`` of subsequences by code, the machine's bias, and the logistic function of a document's measures."""

    weights: np.ndarray
    bias: float
    logistic: np.ndarray


def _measures(worst: list[float]) -> list[float]:
    """Of a document, from the margins of its sentences: the worst ones, and how many are toxic."""
    top = sorted(worst, reverse=True)[:TOP]
    toxic = sum(1 for x in worst if x > 0)
    top += [NONE] * (TOP - len(top))
    return [*np.clip(top, NONE, -NONE), np.log1p(toxic)]


def _logistic(x: np.ndarray, y: np.ndarray, by: np.ndarray, decay: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression, the last one for a constant; Newton steps with a line search."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    keep = np.r_[np.full(x.shape[1] - 1, decay), 1e-6]
    loss = lambda w: (by * np.logaddexp(0, np.where(y, -1, 1) * (x @ w))).sum() + 0.5 * (keep * w * w).sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (by * (p - y)) + keep * w
        step = np.linalg.solve((x * (by * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(keep), g)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w -= size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w


def _machine(z: np.ndarray, y: np.ndarray, by: np.ndarray, cost: float = 30.0) -> np.ndarray:
    """A linear support vector machine with squared hinge loss, its last weight the bias; Newton steps on the active rows."""
    z = np.c_[z, np.ones(len(z), np.float32)]
    sign = np.where(y, 1.0, -1.0)
    w = np.zeros(z.shape[1])
    ridge = np.diag(np.r_[np.ones(z.shape[1] - 1), 1e-3])
    loss = lambda w: 0.5 * w @ ridge @ w + cost * (by * np.maximum(0, 1 - sign * (z @ w)) ** 2).sum()
    for _ in range(NEWTON):
        on = sign * (z @ w) < 1
        a, b = z[on], cost * by[on]
        g = ridge @ w - 2 * a.T @ (b * (sign[on] - a @ w))
        scaled = a * np.sqrt(2 * b).astype(np.float32)[:, None]
        step = np.linalg.solve(ridge + (scaled.T @ scaled).astype(np.float64), g)
        size = 1.0
        while size > 1e-3 and loss(w - size * step) > loss(w):
            size /= 2
        w -= size * step
        if np.abs(size * step).max() < 1e-3 * max(1.0, np.abs(w).max()):
            break
    return w


class Landmarks:
    """Nyström features: the kernel with the landmarks, times the inverse root of the kernel among them."""

    def __init__(self, words: list[str]):
        self.words = words
        codes = [(who, code, weight) for who, code, weight in _subsequences(words)]
        self.codes = np.unique(np.concatenate([c for _, c, _ in codes]))
        self.column = np.full(CODES**3, len(self.codes), np.int32)
        self.column[self.codes] = np.arange(len(self.codes))
        table = np.zeros((len(self.codes) + 1, len(words)))
        for who, code, weight in codes:
            np.add.at(table, (self.column[code], who), weight)
        self.table = table / _norms(words)
        values, vectors = np.linalg.eigh(self.table.T @ self.table)
        some = values > 1e-6 * values[-1]
        self.root = vectors[:, some] / np.sqrt(values[some])
        self.projected = (self.table @ self.root).astype(np.float32)

    def features(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.root.shape[1]), np.float32)
        for a in range(0, len(words), 2048):
            part = words[a : a + 2048]
            for who, code, weight in _subsequences(part):
                column = self.column[code]
                hit = np.flatnonzero(column < len(self.codes))
                starts = np.flatnonzero(np.r_[True, np.diff(who[hit]) != 0]) if len(hit) else hit
                if len(starts):
                    out[a + who[hit[starts]]] += weight * np.add.reduceat(self.projected[column[hit]], starts, axis=0)
            out[a : a + 2048] /= _norms(part)[:, None].astype(np.float32)
        return out

    def folded(self, w: np.ndarray) -> np.ndarray:
        """One weight a subsequence code, equal to a linear function of the features."""
        weights = np.zeros(CODES**3, np.float32)
        weights[self.codes] = (self.table @ (self.root @ w))[:-1]
        return weights


def _first_guess(words: list[str], bags: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Of each piece the mean, by squared weight, of how many standard deviations more toxic documents than expected hold its
    subsequences."""
    codes = list(_subsequences(words))
    by_word, code = np.concatenate([who for who, _, _ in codes]), np.concatenate([c for _, c, _ in codes])
    pair = np.unique(by_word * np.int64(CODES**3) + code)
    by_word, code = pair // CODES**3, pair % CODES**3
    begin = np.searchsorted(by_word, np.arange(len(words) + 1))
    held = np.zeros((2, CODES**3))
    seen = np.zeros(CODES**3, bool)
    for b, t in zip(bags, toxic.tolist(), strict=True):
        size = begin[b + 1] - begin[b]
        at = np.repeat(begin[b] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        seen[:] = False
        seen[code[at]] = True  # documents are counted, not words
        held[int(t)] += seen
    expected = held.sum(axis=0) * toxic.mean()
    surprise = np.clip((held[1] - expected) / np.sqrt(expected + 4), -SURPRISE, SURPRISE)
    total, norm = np.zeros(len(words)), np.zeros(len(words))
    for who, c, weight in codes:
        total += weight**2 * np.bincount(who, surprise[c], len(words))
        norm += weight**2 * np.bincount(who, minlength=len(words))
    return total / np.maximum(norm, 1e-9)


def fit_pieces(words: list[str], bags: list[np.ndarray], toxic: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Subsequence weights and bias from bags of pieces (numbers of ``words``) and which bags are toxic.

    A piece weighs as many documents as it is the worst piece of; of the pieces that count as toxic besides, it does so by
    the toxic documents that hold it.
    """
    rng = np.random.default_rng(7)
    bad = [b for b, t in zip(bags, toxic.tolist(), strict=True) if t and len(b)]
    clean = [b for b, t in zip(bags, toxic.tolist(), strict=True) if not t and len(b)]
    if not bad or not clean:
        return np.zeros(CODES**3, np.float32), -1.0
    none = np.zeros(0, np.int64)
    in_bad, in_clean = (np.bincount(np.concatenate([none, *x]), minlength=len(words)) for x in (bad, clean))
    expected = (in_bad + in_clean) * toxic.mean()
    whole = np.clip((in_bad - expected) / np.sqrt(expected + 4), 0, SURPRISE)
    apart = in_clean <= 0.05 * in_bad
    score = _first_guess(words, bags, toxic) + whole
    # How far a piece stands out by itself or by what it is made of; one that does not was likely taken for want of better.
    trust = np.clip(score / TRUSTED, 0.05, 1)
    usual = np.flatnonzero(in_clean)
    usual = rng.choice(usual, min(len(usual), NEGATIVES), replace=False)
    weights, bias = np.zeros(CODES**3, np.float32), -1.0
    hard = np.zeros(len(words), np.int64)
    for _ in range(rounds):
        worst = lambda groups: np.bincount(np.array([b[np.argmax(score[b])] for b in groups], np.int64), minlength=len(words))  # noqa: E731, B023
        top, hard = worst(bad), worst(clean) + hard // 2
        top[~apart] = 0
        more = (score > 0) & apart & (in_bad > 1)
        positive = np.flatnonzero((top > 0) | more)
        if not len(positive):
            break
        negative = np.union1d(usual[: 30 * len(positive) + 1000], np.flatnonzero(hard))
        by = np.r_[(np.maximum(top, in_bad * more) * trust)[positive], np.maximum(hard[negative], 0.2)].astype(np.float64)
        y = np.arange(len(by)) < len(positive)
        by[y] *= 50 / by[y].sum()
        by[~y] *= 50 / by[~y].sum()
        # Landmarks: the most frequent worst pieces of either kind, and some of all.
        quarter = LANDMARKS // 4
        often = lambda of, count: of[np.argsort(-count[of], kind="stable")[:quarter]]
        some = lambda of: rng.choice(of, min(quarter, len(of)), replace=False)
        chosen = np.concatenate([often(positive, np.maximum(top, in_bad * more) * trust), some(positive), often(np.flatnonzero(hard), hard), some(negative)])
        marks = Landmarks([words[k] for k in np.unique(chosen).tolist()])
        w = _machine(marks.features([words[k] for k in np.r_[positive, negative].tolist()]), y, by)
        weights, bias = marks.folded(w[:-1]), float(w[-1])
        margin = _margins(words, weights, bias)
        score = margin + 0.1 * whole
    return weights, bias


class Scorer:
    """Margins of words, looked up or computed many at a time."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.known: dict[str, float] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        parts = [pieces(w) for w in new]
        flat = [p for ps in parts for p in ps]
        margin = _margins(flat, self.weights, self.bias).tolist()
        at = 0
        for w, ps in zip(new, parts, strict=True):
            self.known[w] = max(margin[at : at + len(ps)], default=NONE)
            at += len(ps)

    def margins(self, cut: list[list[str]]) -> list[float]:
        """Of each sentence, given by its words, the worst piece's margin."""
        self.learn({w for s in cut for w in s})
        return [max(map(self.known.__getitem__, s)) for s in cut]

    def documents(self, texts: list[str | None]) -> list[list[float]]:
        """For each text the margins of its sentences."""
        out = []
        for a in range(0, len(texts), 100):
            cut = [sentences(t) for t in texts[a : a + 100]]
            self.learn({w for doc in cut for s in doc for w in s})
            get = self.known.__getitem__
            out += [[max(map(get, s)) for s in doc] for doc in cut]
        return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sampled document's different sentences, their words apart by one space."""
    for batch in batches:
        cut = [sorted({" ".join(s) for s in sentences(t)}) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(cut, pa.list_(pa.string()))], names=["doc_id", "toxic", "sentences"])


def _new_sentences(docs: list[list[str]], toxic: np.ndarray) -> list[list[str]]:
    """Of each document the sentences that no clean one, and of its kind none before it, has: copies are no evidence."""
    seen: set[str] = set()
    out: list[list[str]] = [[] for _ in docs]
    for k in np.argsort(toxic, kind="stable").tolist():
        out[k] = [s for s in docs[k] if s not in seen]
        seen.update(out[k])
    return out


def _fitted(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.assign(key=[zlib.crc32("\n".join(p).encode()) for p in pdf["sentences"]]).sort_values(["doc_id", "key"], kind="stable").drop_duplicates("doc_id")
    toxic = pdf["toxic"].to_numpy() == 1
    if toxic.all() or not toxic.any():
        return pd.DataFrame({"codes": [b""], "weights": [b""], "bias": [0.0], "logistic": [[]]})
    docs = [list(s) for s in pdf["sentences"]]

    def machine(use: np.ndarray) -> tuple[np.ndarray, float]:
        number: dict[str, int] = {}
        learn = _new_sentences([d for d, x in zip(docs, use.tolist(), strict=True) if x], toxic[use])
        bags = [np.array(sorted({number.setdefault(p, len(number)) for s in d for w in s.split(" ") for p in pieces(w)}), np.int64) for d in learn]
        return fit_pieces(list(number), bags, toxic[use])

    # The logistic function is fitted on documents that the machine has not seen: a third of them, or, of a small sample,
    # each third with a machine for the others, and then one for all.
    fold = np.array([zlib.crc32(f"fold {d}".encode()) % 3 for d in pdf["doc_id"]])
    measures, rest = np.zeros((len(docs), len(_measures([])))), np.zeros(len(docs), bool)
    for k in range(3 if len(docs) < SMALL_SAMPLE else 1):
        weights, bias = machine(fold != k)
        scorer = Scorer(weights, bias)
        for d in np.flatnonzero(fold == k).tolist():
            measures[d] = _measures(scorer.margins([s.split(" ") for s in docs[d]]))
        rest |= fold == k
    if len(docs) < SMALL_SAMPLE:
        weights, bias = machine(np.ones(len(docs), bool))
    measures = measures[rest]
    share = pdf["share"].iloc[0]
    y = toxic[rest]
    by = np.where(y, share / max(1, y.sum()), (1 - share) / max(1, (~y).sum())) * len(y)
    # More evidence never makes a document less toxic: measures that would are left out.
    use = np.ones(measures.shape[1], bool)
    while True:
        found = _logistic(measures[:, use], y, by)
        if (found[:-1] >= 0).all():
            break
        use[np.flatnonzero(use)[found[:-1] < 0]] = False
    logistic = np.zeros(len(use) + 1)
    logistic[:-1][use], logistic[-1] = found[:-1], found[-1]
    some = np.flatnonzero(weights).astype(np.int32)
    return pd.DataFrame({"codes": [some.tobytes()], "weights": [weights[some].tobytes()], "bias": [bias], "logistic": [logistic.tolist()]})


def _learned() -> Column:
    return F.crc32(F.col("doc_id").cast("long").cast("string")) % 3 != 1


def fit(docs: DataFrame, labels: DataFrame, sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN) -> Model | None:
    """The model, fitted in one task on a bounded sample of labelled documents; None without labels of both kinds."""
    bounded_batches(docs.sparkSession)
    rows = labels.where(_learned()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = rows.where("toxic = 1").orderBy(*by).limit(sample_toxic).unionByName(rows.where("toxic = 0").orderBy(*by).limit(sample_clean))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    bags = texts.select("doc_id", "text", "toxic").mapInArrow(_cut, "doc_id long, toxic int, sentences array<string>")
    bags = bags.withColumn("share", F.lit(counts[1] / (counts[0] + counts[1])))
    found = bags.groupBy(F.lit("all").alias("all")).applyInPandas(_fitted, "codes binary, weights binary, bias double, logistic array<double>").first()
    if found is None or not found.logistic:
        return None
    weights = np.zeros(CODES**3, np.float32)
    weights[np.frombuffer(bytes(found.codes), np.int32)] = np.frombuffer(bytes(found.weights), np.float32)
    return Model(weights, found.bias, np.array(found.logistic))


def _scored(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.weights, model.bias) if model else None
        for batch in batches:
            n = batch.num_rows
            score, toxic = np.zeros(n), np.zeros(n, np.int64)
            if scorer:
                margins = scorer.documents(batch.column("text").to_pylist())
                x = np.array([_measures(m) for m in margins]).reshape(n, -1)
                score = 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(n)] @ model.logistic, -40, 40)))
                score[[not m for m in margins]] = 0
                toxic[:] = [sum(1 for y in m if y > 0) for m in margins]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array(toxic)], names=["doc_id", "score", "n_toxic_sentences"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: doc_id, held_out (its label may not be learned), score (0 to 1), predicted and how many of its
    sentences the machine calls toxic."""
    model = fit(docs, labels)
    bounded_batches(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = read.mapInArrow(_scored(model), "doc_id long, score double, n_toxic_sentences long")
    held = F.coalesce(~_learned(), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_toxic_sentences")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not called toxic; same columns."""
    model = fit(docs, labels)
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scored(model)
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column("text")], names=["doc_id", "text"])
            yield batch.filter(pa.array(next(score(iter([texts]))).column("score").to_numpy() < threshold))

    return docs.mapInArrow(run, docs.schema)
