"""The kernel against its definition, the folded weights against the kernel machine, held-out documents, and odd rows."""

import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from rivulet.llm import toxicity as m
from rivulet.llm.toxicity import Landmarks, drop_toxic, fit_pieces, pieces, score_toxicity, sentences

INSULTS = ["grobian", "schuft", "lump"]


def features(word):
    s = [m.FIRST, *m._codes(word).tolist(), m.LAST]
    out = Counter()
    for a, b, c in combinations(range(len(s)), 3):
        if c - a < m.SPAN:
            out[s[a], s[b], s[c]] += m.DECAY ** (c - a - 2)
    return out


def norm(word):
    n = len(word) + 2
    return sum(m.DECAY ** (2 * (c - a - 2)) for a, b, c in combinations(range(n), 3) if c - a < m.SPAN) ** 0.5


def kernel(x, y):
    fx, fy = features(x), features(y)
    return sum(v * fy[k] for k, v in fx.items()) / (norm(x) * norm(y)) if norm(x) and norm(y) else 0.0


def test_kernel_and_folding():
    marks = ["idiot", "clown", "été", "a", "moonlight"]
    words = ["idiot", "idxiot", "clowns", "tée", "b", "moon", "zzzz"]
    land = Landmarks(marks)
    z = land.features(words)
    gram = np.array([[kernel(x, y) for y in marks] for x in words])
    inner = np.array([[kernel(x, y) for y in marks] for x in marks])
    # Nyström: the features' products are the kernel, as the landmarks see it.
    assert np.allclose(z @ z.T, gram @ np.linalg.pinv(inner) @ gram.T, atol=1e-4)
    w = np.random.default_rng(0).normal(size=z.shape[1])
    assert np.allclose(m._margins(words, land.folded(w), 0.25), z @ w + 0.25, atol=1e-4)
    assert kernel("idiot", "idxiot") > 0.5 > kernel("idiot", "clown")


def test_pieces_and_sentences():
    assert pieces("I.d-i_o*t!") == ["idiot"] and pieces("---") == [] and pieces("É") == ["é"]
    long = "abcdefghij" * 10
    assert all(len(p) <= m.PIECE for p in pieces(long)) and pieces(long)[-1].endswith("j") and long[25:35] in "".join(pieces(long)[1:2])
    assert sentences("You i d i o t now. Go on!\n\nA b c") == [["You", "idiot", "now."], ["Go", "on!"], ["Abc"]]
    assert sentences(None) == [] and sentences(" \n ") == []


def corpus(n, seed, insult):
    rng = random.Random(seed)
    syllables = ["ta", "re", "mi", "so", "lu", "ne", "va", "di", "ko", "pe"]
    rows = []
    for k in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(20, 80))]
        for j in range(7, len(words), 9):
            words[j] += "."
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), insult(rng))
        rows.append((k + 1000 * seed, " ".join(words), int(toxic)))
    return rows


def varied(rng):
    w = rng.choice(INSULTS)
    kind = rng.randrange(5)
    at = rng.randrange(1, len(w))
    return [w, w[:at] + rng.choice("xz*-") + w[at:], " ".join(w), w + rng.choice(["en", "e", "s"]), w.upper() + "!"][kind]


@pytest.fixture(scope="module")
def learned(spark):
    rows = corpus(900, 1, varied)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t, _ in rows], "doc_id long, text string, score string, toxic int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return rows, docs, labels


def test_gapped_and_inserted_insults(spark, learned):
    rows, docs, labels = learned
    got = {r.doc_id: r for r in score_toxicity(docs, labels).collect()}
    assert len(got) == len(rows)
    held = [(got[i].predicted, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)
    assert np.mean([p for p, y in held if y]) >= 0.9 and np.mean([p for p, y in held if not y]) <= 0.02
    kept = {r.doc_id for r in drop_toxic(docs, labels).collect()}
    assert kept == {i for i in got if got[i].predicted == 0}


def test_held_out_labels_are_not_learned(spark, learned):
    rows, docs, labels = learned
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) as toxic")
    by_id = lambda df: {r.doc_id: r.score for r in df.collect()}
    assert by_id(score_toxicity(docs, labels)) == by_id(score_toxicity(docs, turned))


def test_odd_rows(spark, learned):
    rows, docs, labels = learned
    text = next(t for _, t, y in rows if y)
    odd = [(-1, None), (-2, ""), (-3, " \n\t "), (-4, "..."), (-5, "ta re mi. " * 20000), (-6, "x" * 100000), (-7, text), (-7, text), (None, text)]
    more = spark.createDataFrame([(i, t, "x", 0) for i, t in odd], docs.schema)
    noise = spark.createDataFrame([(None, 1), (5, None), (rows[0][0], 0)], labels.schema)
    got = score_toxicity(docs.unionByName(more), labels.unionByName(noise)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[k][0].score == 0 and by[k][0].predicted == 0 for k in (-1, -2, -3))
    assert by[-4][0].predicted == by[-5][0].predicted == by[-6][0].predicted == 0
    assert by[-7][0].score == by[-7][1].score == by[None][0].score and by[None][0].held_out is False
    assert all(0 <= r.score <= 1 for r in got)
    assert score_toxicity(docs.limit(0), labels).collect() == []
    assert {r.score for r in score_toxicity(docs.limit(20), labels.where("toxic = 0")).collect()} == {0.0}


def test_copies_are_no_evidence():
    docs = [["a b", "c d"], ["a b", "you lump"], ["a b", "you lump"], ["e f"]]
    assert m._new_sentences(docs, np.array([False, True, True, False])) == [["a b", "c d"], ["you lump"], [], ["e f"]]


def test_rare_words_of_one_document_do_not_win():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)] + ["schuft"]
    bags = [np.unique(np.array([rng.randrange(3000) for _ in range(30)] + ([3000] if k % 4 == 0 else []))) for k in range(200)]
    weights, bias = fit_pieces(words, bags, np.array([k % 4 == 0 for k in range(200)]), rounds=3)
    margin = m._margins(["schuft", "schxuft", "schufte", *words[:50]], weights, bias)
    assert (margin[:3] > 0).all() and (margin[3:] < margin[:3].min()).all()


def test_held_out_documents_of_the_tables(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r.predicted for r in got if r.toxic], [r.predicted for r in got if not r.toxic]
    assert np.mean(toxic) >= 0.75 and np.mean(clean) <= 0.01
