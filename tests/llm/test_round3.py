"""Quality classifier, phrase collocations and embedding whitening."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from conftest import SF_SMALL
from procura.llm import phrases, quality, queries, whitening

# --- op 11 ------------------------------------------------------------------------------------


def _documents(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t in rows], "doc_id long, text string, `a.b` string, score double")
    return docs, spark.createDataFrame([(i, q, None) for i, q in labels], "doc_id long, quality int, text string")


def _quality_rows(n=400):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("aeilnorst", k=rnd.randint(2, 8)))
    rows, labels = [], []
    for i in range(n):
        words = [word() + rnd.choice(["", "", "", ","]) for _ in range(rnd.randint(30, 200))]
        bad = i % 4 == 0
        if bad:
            words = [[w + "%%%" for w in words], [w.upper() for w in words], words[:1] * len(words)][i // 4 % 3]
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(not bad)))
    return rows, labels


def test_quality(spark):
    rows, labels = _quality_rows()
    extra = [(1000, None), (1001, ""), (1002, "plain words " * 30_000), (5, rows[5][1]), (5, rows[5][1]), (None, "plain words")]
    docs, known = _documents(spark, rows + extra, labels + [(7, None), (None, 1), (9, 1)])
    got = quality.quality(docs, known).collect()
    assert len(got) == len(rows) + len(extra)
    want = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert held and all(r.predicted == want[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert len({r.score for r in got if r.doc_id == 5}) == 1
    assert len({r.score for r in got if r.doc_id in (1000, 1001)}) == 1


def test_quality_ignores_held_out_labels(spark):
    rows, labels = _quality_rows(200)
    docs, known = _documents(spark, rows, labels)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    _, other = _documents(spark, rows, flipped)
    score = lambda k: sorted((r.doc_id, round(r.score, 9)) for r in quality.quality(docs, k).collect())
    assert score(known) == score(other)


@pytest.mark.parametrize(("labels", "want"), [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0)])
def test_quality_without_both_classes(spark, labels, want):
    assert zlib.crc32(b"1") % 5 and zlib.crc32(b"2") % 5
    docs, known = _documents(spark, [(1, "a b"), (2, "c")], labels)
    assert {r.score for r in quality.quality(docs, known).collect()} == {want}


def test_quality_of_nothing(spark):
    docs, known = _documents(spark, [], [(1, 1)])
    assert quality.quality(docs, known).collect() == []


def test_class_moments_and_densities_against_numpy(spark):
    rows, labels = _quality_rows(120)
    docs, known = _documents(spark, rows, labels)
    counts = quality.text_counts(docs.select("doc_id", "text"))
    exact = np.array([quality.counts_of(t) for _, t in rows], float)
    x, good = quality.statistics(exact, exact.sum(0)), np.array([q for _, q in labels])
    found = quality.class_moments(
        counts.join(known.withColumnRenamed("quality", "good").select("doc_id", "good"), "doc_id").select("good", *quality.COUNTS),
        exact.sum(0),
    )
    for k in (0, 1):
        n, mean, covariance = found[k]
        assert n == (good == k).sum()
        assert np.allclose(mean, x[good == k].mean(0)) and np.allclose(covariance, np.cov(x[good == k].T, bias=True))
    model = quality.Model(exact.sum(0))
    covariance = quality.regularised(found[1][2], found[1][2], 0.1, 0.02)
    model.add(found[1][1], covariance, 0.25)
    off = x - found[1][1]
    want = np.log(0.25) - (off @ np.linalg.inv(covariance) * off).sum(1) / 2 - np.linalg.slogdet(covariance)[1] / 2
    assert np.allclose(model.density(x, 0), want)


# --- op 12 ------------------------------------------------------------------------------------


def _brute(rows, least, top, most=5):
    """Every phrase counted, every cut scored, every longer candidate compared."""
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, most + 1):
                for i in range(len(words) - m + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and often.get(p[i:j], -1) <= a}
        found = []
        for p, a in often.items():
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def _phrase_rows(seed, n=300):
    rnd = random.Random(seed)
    common, rare = ["the", "of", "A", "b"], [f"w{i}" for i in range(30)]
    rows = []
    for _ in range(n):
        words = []
        while len(words) < rnd.randint(0, 40):
            words += rnd.choice([rnd.choices(common, k=2), [rnd.choice(rare)], ["New", "york", "city"], ["x"] * rnd.randint(1, 7),
                                 ["of", "w1", "w2", "w3", "w4", "w5"][: rnd.randint(2, 6)], ["é", "ñu", "\x00z"]])
            words[-1] += rnd.choice(["", "", "", "", ",", ".", "\n", "\x0b"])
        rows.append((rnd.choice([" ", "  ", "\t"]).join(words), rnd.choice(["en", "en", "en", "es", None, "und"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("top", [5, 60, 2000])
def test_collocations_against_brute_force(spark, seed, top):
    rows = _phrase_rows(seed) + [(None, "en"), ("", "en"), ("one two " * 2000, "de"), ("q r s. " * 40, "fr"), ("q r s. " * 40, "fr")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, n int, `a.b` string")
    got = phrases.collocations(docs, least_count=8, top=top, growth=2.0)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 8, top)


def test_collocations_with_colliding_hashes(spark, monkeypatch):
    """Word hashes that collide are replaced; phrase hashes that collide are told apart."""
    plain = phrases.word_hash
    assert phrases.injective_seed(spark.createDataFrame([("a",), ("b",), ("a",)], "word string")) == 0
    run = np.array([3, 4, 5, 4, 3, 4], np.uint64)
    order, first = phrases._groups(np.zeros(3, np.uint64), np.array([0, 2, 4]), run, 2)
    assert sorted(np.diff(np.r_[first, 3]).tolist()) == [1, 2] and plain(b"a", 0) != plain(b"a", 1)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(docs).collect() == []
    assert phrases.collocations(spark.createDataFrame([("a b c", "en")], "text string, lang string")).collect() == []


def test_collocations_sql_against_brute_force():
    rows = _phrase_rows(5)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r for r in rows if "\x00" not in (r[0] or "")] * 6)
    got = con.execute(queries.SQL["op12_collocations"]).fetchall()
    assert sorted(got) == _brute([r for r in rows if "\x00" not in (r[0] or "")] * 6, 100, 2000) and got


# --- op 13 ------------------------------------------------------------------------------------


MATRICES = {
    "random": lambda g: g.normal(size=(200, 24)),
    "graded": lambda g: g.normal(size=(200, 24)) * np.logspace(0, -8, 24),
    "repeated columns": lambda g: np.repeat(g.normal(size=(200, 6)), 4, axis=1),
    "equal values": lambda g: np.linalg.qr(g.normal(size=(100, 20)))[0],
    "clusters": lambda g: np.kron(np.eye(4), np.linalg.qr(g.normal(size=(20, 20)))[0][:, :10] * np.logspace(0, -3, 10)),
    "nearly equal": lambda g: np.linalg.qr(g.normal(size=(100, 12)))[0] * (1 + 1e-9 * np.arange(12)),
    "one column": lambda g: g.normal(size=(30, 1)),
    "fewer rows": lambda g: g.normal(size=(5, 12)),
    "zero": lambda g: np.zeros((6, 4)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver_against_numpy(name):
    a = MATRICES[name](np.random.default_rng(1))
    r = np.linalg.qr(a, mode="r")
    r = np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])
    diagonal, above, v = whitening.bidiagonal(r)
    assert np.allclose(v.T @ v, np.eye(len(v)), atol=1e-13)
    singular = whitening.dqds(diagonal, above)
    want = np.linalg.svd(r, compute_uv=False)
    assert np.abs(singular - want).max() <= 1e-13 * max(want[0], 1e-300)
    kept = singular[singular > whitening.SMALLEST * singular[0]]
    x = v @ whitening.right_vectors(diagonal, above, kept)
    assert np.allclose(x.T @ x, np.eye(len(kept)), atol=1e-10)
    assert np.abs(r.T @ (r @ x) - x * kept**2).max(initial=0) <= 1e-12 * max(want[0] ** 2, 1e-300)


def test_dqds_is_accurate_for_small_values():
    """Relative accuracy, which forming B'B would lose."""
    diagonal, above = np.logspace(0, -60, 16), np.logspace(-1, -61, 16)[:-1]
    found = whitening.dqds(diagonal, above)
    assert np.isclose(np.log(found).sum(), np.log(diagonal).sum(), rtol=1e-13) and found[-1] < 1e-55


def _whole(c):
    return [int(np.floor(1024 * float(x))) + 100_000 for x in c]


def test_whitening(spark):
    g = np.random.default_rng(5)
    base = (g.normal(size=(300, 12)) * np.linspace(0.2, 2, 12)).astype("f4").tolist()
    odd = [None, [None] + base[0][1:], [float("nan")] + base[0][1:], [float("inf")] + base[0][1:], [], base[0][:5]]
    rows = [(i, v) for i, v in enumerate(base)] + [(7, base[3]), (None, base[4])] + [(1000 + i, v) for i, v in enumerate(odd)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, n int, `a.b` string")
    got = whitening.whiten(docs.repartition(40)).collect()
    kept = [(i, v) for i, v in rows if v in base and (i is None or i < 1000)]
    assert len(got) == 8 * len(kept)
    x = np.array([_whole(np.float32(v)) for _, v in kept], object)
    n, s = len(kept), x.sum(0)
    centred = (x * n - s).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:8]
    deviation = {(i, int(((r * n - s) ** 2).sum())) for (i, _), r in zip(kept, x)}
    assert {(r.vec_id, r.deviation) for r in got} == deviation == {(r.vec_id, int(r.deviation_wide)) for r in got}
    assert {r.n for r in got} == {n} and all(r.identity_error <= 1e-10 for r in got)
    for k, at in enumerate(order, 1):
        own = sorted((r.vec_id if r.vec_id is not None else -1, r.whitened) for r in got if r.component == k)
        want = centred @ vectors[:, at] / np.sqrt(values[at])
        want = sorted(((i if i is not None else -1), w) for (i, _), w in zip(kept, want))
        a, b = np.array([w for _, w in own]), np.array([w for _, w in want])
        assert min(np.abs(a - b).max(), np.abs(np.sort(a) + np.sort(b)[::-1]).max()) < 1e-8 or np.allclose(np.abs(a), np.abs(b), atol=1e-8)
        assert np.isclose(next(r.explained for r in got if r.component == k), values[at] / values.sum(), rtol=1e-10)


def test_whitening_rank_and_size(spark):
    vectors = spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0]) for i in range(10)], "vec_id long, embedding array<double>")
    got = whitening.whiten(vectors).collect()
    assert {r.component for r in got} == {1} and len(got) == 10 and abs(got[0].explained - 1) < 1e-9
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(vectors.filter("vec_id < 0")).collect() == []


def test_whitening_of_large_numbers_stays_exact(spark):
    values = [2.0**50, -(2.0**50), 1.0, 0.0, 2.0**51]
    vectors = spark.createDataFrame([(i, [v, -v / 2]) for i, v in enumerate(values)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in whitening.whiten(vectors).collect()}
    x = {i: _whole([v, -v / 2]) for i, v in enumerate(values[:4])}
    s = [sum(c) for c in zip(*x.values())]
    for i, own in x.items():
        exact = sum((4 * a - b) ** 2 for a, b in zip(own, s))
        assert int(got[i].deviation_wide) == exact and got[i].deviation == (exact if exact < 2**63 else None)
    assert got[0].deviation is None
    assert set(got) == set(x)


@pytest.mark.parametrize("name", ["op11_quality", "op13_whitening"])
def test_registered(spark, name):
    rows = queries.QUERIES[name](spark, SF_SMALL).collect()
    assert len(rows) == (200 if name == "op11_quality" else 8 * len({r.vec_id for r in rows}))
