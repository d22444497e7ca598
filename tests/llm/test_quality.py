import math
import random

import numpy as np
from pyspark.sql import functions as F

from rivulet.llm.quality import KEEP, LEAST_RATIO, LEAST_SEEN, LEAST_SHARE, PRIOR, Features, classify, fit, fit_ordinal, graded, keep_good

DOCS = "doc_id long, text string, grade string, kept string"


def test_fit_orders_grades():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(600):
        g = int(rng.choice([0, 1, 2], p=[0.2, 0.2, 0.6]))
        words = set(rng.integers(100, 400, 30).tolist())
        words |= {0: {1, 2}, 1: {3}, 2: set()}[g]
        rows.append(np.array(sorted(words)))
        grades.append(g)
    names, w, cuts = fit_ordinal(rows, np.array(grades))
    weight = dict(zip(names.tolist(), w.tolist()))
    assert cuts[0] < cuts[1] and weight[1] < 0 and weight[3] < 0
    s = np.array([sum(weight.get(int(f), 0.0) for f in r) for r in rows])
    grade = (s[:, None] > cuts).sum(axis=1)
    assert (grade == np.array(grades)).mean() > 0.95


def test_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = classify(docs, labels.where("doc_id % 3 != 0")).join(graded(labels).where("doc_id % 3 = 0"), "doc_id")
    share = {r.grade: r.kept for r in out.groupBy("grade").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert share[2] > 0.985 and share[0] < 0.05 and share[1] < 0.1, share


def test_edges(spark):
    bad, good = "idiot scum trash " * 3, "plain words of prose "
    rows = [(i, bad if i % 3 == 0 else good * (1 + i % 5)) for i in range(120)] + [(200, None), (201, ""), (202, good * 40_000), (203, good * 40_000 + "idiot scum trash"), (5, good)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(100)] + [(7, None, None), (None, 1, 1), (8, 1, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in classify(docs, labels).collect()}
    assert len(out) == 124 and not out[102].kept and out[101].kept and out[202].kept and not out[203].kept
    assert 0 <= out[102].expected_grade < out[101].expected_grade <= 2
    blank = spark.createDataFrame([(300, " \n\t", "x", "y")], docs.schema) if len(docs.columns) == 4 else None
    assert all(not out[k].kept and out[k].p_good == 0 == out[k].expected_grade for k in (200, 201))
    assert blank is None or not classify(docs.unionByName(blank), labels).where("doc_id = 300").first().kept
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in classify(docs, labels).where("kept").collect())
    assert classify(docs.where("false"), labels).collect() == [] and keep_good(docs.where("false"), labels).collect() == []
    assert all(r.kept and r.p_good == 1 for r in classify(docs, labels.where("false")).collect())


def plain_fit(rows, grades, steps, decay=3e-4):
    """The same model, written out: objective by the definition, gradients by differences, the same steps."""
    n, top = len(rows), max(2, max(grades))
    share = [grades.count(k) for k in range(top + 1)]
    chosen = {}
    for f in sorted({f for r in rows for f in r}):
        seen = [sum(f in r for r, g in zip(rows, grades) if g == k) for k in range(top + 1)]
        rate = [(seen[k] + PRIOR * sum(seen) / n) / (share[k] + PRIOR) for k in range(top + 1)]
        ratio = min(math.log(rate[top] / rate[k]) for k in range(top))
        if ratio <= -LEAST_RATIO and sum(seen) >= max(LEAST_SEEN, LEAST_SHARE * n):
            chosen[f] = ratio
    names = list(chosen)
    weight = [math.sqrt(n / max(share[g], 1) / sum(x > 0 for x in share)) for g in grades]
    weight = [x / sum(weight) for x in weight]
    sigmoid = lambda z: 1 / (1 + math.exp(-min(max(z, -40), 40)))

    def objective(p):
        w, theta = dict(zip(names, p)), p[len(names) :]
        cuts = [-math.inf, theta[0]]
        for t in theta[1:]:
            cuts.append(cuts[-1] + math.exp(t))
        cuts.append(math.inf)
        total = sum(decay / 2 * (x - 0.3) ** 2 for x in w.values())
        for r, g, b in zip(rows, grades, weight):
            s = sum(w[f] * chosen[f] for f in r if f in w)
            total -= b * math.log(sigmoid(cuts[g + 1] - s) - sigmoid(cuts[g] - s))
        return total

    p = [0.3] * len(names) + [-1.0] + [math.log(2.0)] * (top - 1)
    m, v = [0.0] * len(p), [0.0] * len(p)
    for step in range(1, steps + 1):
        grad = []
        for k in range(len(p)):
            up, down = list(p), list(p)
            up[k] += 1e-6
            down[k] -= 1e-6
            grad.append((objective(up) - objective(down)) / 2e-6)
        for k, g in enumerate(grad):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] -= 0.05 * (m[k] / (1 - 0.9**step)) / (math.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
            if k < len(names):
                p[k] = max(p[k], 0)
    cuts = [p[len(names)]]
    for t in p[len(names) + 1 :]:
        cuts.append(cuts[-1] + math.exp(t))
    return {f: x * chosen[f] for f, x in zip(names, p)}, cuts


def test_fit_against_a_plain_version():
    rng = random.Random(2)
    rows, grades = [], []
    for k in range(150):
        g = rng.choice([0, 1, 2, 2, 2])
        bad = {0: [1, 2, 3], 1: [3, 4], 2: []}[g]
        rows.append(sorted({rng.randrange(10, 14) for _ in range(3)} | {f for f in bad if rng.random() < 0.8} | ({4} if k % 50 == 0 else set())))
        grades.append(g)
    want, want_cuts = plain_fit(rows, grades, 25)
    names, w, cuts = fit_ordinal([np.array(r) for r in rows], np.array(grades), steps=25)
    assert len(want) >= 3 and sorted(want) == names.tolist()
    assert np.allclose([want[f] for f in names.tolist()], w, atol=1e-3) and np.allclose(want_cuts, cuts, atol=1e-3)


def test_scores_against_a_plain_version(spark):
    """Expected grade and tail probability of whole texts from the model's own weights."""
    rows = [(i, ("idiot scum trash " if i % 3 == 0 else "plain words of prose ") * (1 + i % 4), "x", "y") for i in range(90)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(80)], "doc_id long, quality int, toxic int")
    weights, cuts = fit(docs, graded(labels))
    for r in classify(docs, labels).collect():
        s = sum(weights.get(f, 0.0) for f in Features()(rows[r.doc_id][1]))
        tails = [1 / (1 + math.exp(-(s - c))) for c in cuts]
        assert abs(r.expected_grade - sum(tails)) < 1e-9 and abs(r.p_good - tails[-1]) < 1e-9 and r.kept == (tails[-1] >= KEEP)
