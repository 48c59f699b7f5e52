"""Toxicity (exact chain sums, held-out accuracy) and nearest neighbours (recall against brute force)."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from procura.llm import ann, toxicity


@pytest.mark.parametrize("block", [64, 3])
def test_chain_against_all_paths(block, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(0)
    step = np.exp(rng.normal(size=(2, 2)) * 2)
    lengths = np.array([3, 0, 1, 9, 5])
    e = rng.normal(size=lengths.sum()) * 3
    got = toxicity.marginals(e, lengths, -0.5, step)
    inner, want, pairs, at = np.ones(len(e), bool), [], np.zeros((2, 2)), 0
    for n in lengths[lengths > 0]:
        inner[at] = False
        mass, ones, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(-0.5 * y[0] + sum(e[at + i] * y[i] for i in range(n)))
            for a, b in itertools.pairwise(y):
                w *= step[a, b]
            mass += w
            ones += w * np.array(y)
            for a, b in itertools.pairwise(y):
                moves[a, b] += w
        want.extend(ones / mass)
        pairs += moves / mass
        at += n
    assert np.allclose(got, want)
    assert np.allclose(toxicity.pair_marginals(e, *toxicity.chain(e, lengths, -0.5, step), step, inner), pairs)


def _toxic_rows():
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choices("aeilnorst", k=rnd.randint(3, 7)))
    bad = ["grunk", "skazz", "blorfen"]
    rows, labels = [], []
    for i in range(600):
        words = [word() for _ in range(rnd.randint(5, 60))]
        toxic = int(i % 5 == 0)
        for _ in range(3 * toxic):
            words.insert(rnd.randrange(len(words)), rnd.choice(bad) + rnd.choice(["", "ix", "!"]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_toxicity(spark):
    rows, labels = _toxic_rows()
    extra = [(1000, None), (1001, ""), (1002, "grunk skazz " * 3000), (5, rows[5][1]), (None, "plain words")]
    docs = spark.createDataFrame([(d, t, 0.5, "x") for d, t in rows + extra], "doc_id long, text string, score double, spans string")
    label = spark.createDataFrame([*labels, (3, None), (None, 1), (7, labels[7][1])], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, label).collect()
    assert len(out) == len(rows) + len(extra)
    got = {r.doc_id: r for r in out}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in held) for i in range(600)) and got[None].held_out is False
    right = np.mean([got[i].predicted == labels[i][1] for i in held])
    assert right >= 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert got[1000].predicted == got[1001].predicted == 0 and got[1002].predicted == 1
    text = dict(rows)
    spanned = [text[i][s.begin : s.end] for i in held if labels[i][1] for s in got[i].spans]
    assert spanned and np.mean([any(b in s for b in ("grunk", "skazz", "blorfen")) for s in spanned]) > 0.95


def test_toxicity_uses_no_held_out_label(spark):
    rows, labels = _toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flipped = [(d, 1 - y if zlib.crc32(str(d).encode()) % 5 == 0 else y) for d, y in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert a.weights == b.weights and np.array_equal(a.layer, b.layer)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    label = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.toxicity(docs, label).collect()] == [0.0]
    assert toxicity.toxicity(docs.limit(0), label).count() == 0


def _brute(rows, k=10):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.asarray(v) != 0):
            ok[i] = min(ok.get(i, v), v)
    ids = np.array(sorted(ok))
    vec = np.array([ok[i] for i in ids])
    out = {}
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((vec - np.array(ok[q])) ** 2).sum(1))
        best = sorted((d[j], i) for j, i in enumerate(ids) if i != q)[:k]
        out[int(q)] = [int(i) for _, i in best]
    return out


def test_nearest_neighbours(spark):
    vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    want = _brute(rows)
    got = {}
    for r in ann.nearest(vectors, F.col("id") % 100 == 0, block=64).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    recall = np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want])
    assert recall >= 0.9


def test_nearest_neighbours_ties_and_bad_rows(spark):
    rows = [(100 + i, [1.0, 0.0]) for i in range(40)] + [(300, [0.0, 1.0]), (7, [0.0, 0.0]), (8, None), (9, [float("nan"), 1.0]),
            (10, [1.0]), (11, [None, 1.0]), (None, [1.0, 1.0]), (300, [0.0, 1.0]), (12, [float("inf"), 1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, node int")
    out = ann.nearest(df, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect()
    got = {q: [(r.vec_id, r.score) for r in out if r.query_id == q] for q in (100, 300)}
    assert got[100] == [(100 + i, 0.0) for i in range(1, 11)]
    assert [i for i, _ in got[300]] == list(range(100, 110)) and got[300][0][1] == pytest.approx(2**0.5)
    assert ann.nearest(df.limit(0), F.col("id") % 100 == 0).count() == 0
    one = df.filter("vec_id = 300")
    assert ann.nearest(one, F.col("id") % 100 == 0).count() == 0
