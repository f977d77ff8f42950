import math
import re
import zlib

import numpy as np
import pytest

from plumbline.llm import mil, toxicity

SF = "/root/testdata/sf0.01"


def test_ordinal_gradient_and_thresholds():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 800)
    # feature g occurs from grade g on; the rest is noise
    rows = [np.unique(np.concatenate([np.arange(1, g + 1), 100 + rng.integers(0, 50, 12)])) for g in grades]
    m = toxicity.fit_arrays(rows, grades)
    assert len(m.thetas) == 3 and (np.diff(m.thetas) > 0).all()
    s, g = m.severity(np.array([m.linear(r) for r in rows]))
    assert (g == grades).mean() > 0.9 and np.corrcoef(s, grades)[0, 1] > 0.95 and s.min() >= 0 and s.max() <= 3


def test_ordinal_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(4)
    n, m, levels = 30, 8, 4
    grades = rng.integers(0, levels, n)
    flat, owner, value = rng.integers(0, m, 90), np.repeat(np.arange(n), 3), rng.normal(size=90)
    w, gap, weight = rng.normal(size=m), rng.normal(size=levels - 1), rng.random(n)
    told = lambda: toxicity.loss_and_gradient(w, gap, flat, owner, value, grades, weight, 0.01)
    _, gw, gg = told()
    for x, g in ((w, gw), (gap, gg)):
        for i in range(len(x)):
            old = x[i]
            x[i] = old + 1e-6
            up = told()[0]
            x[i] = old - 1e-6
            down = told()[0]
            x[i] = old
            assert abs((up - down) / 2e-6 - g[i]) < 1e-5


def test_toxicity_scores_against_brute_force(spark):
    """Severity and grade of real texts, from the words of each text one by one and the definition of the model."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels, "toxic")
    got = {r.doc_id: r for r in toxicity.score(docs.select("doc_id", "text").limit(150), model).collect()}

    def places(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return next(toxicity.features(data, np.array([0, len(data)]))).tolist()

    for r in docs.limit(150).collect():
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or ""))
        z = sum(model.weights[p] for p in {p for x in {*words} for p in places(x)})
        above = [1 / (1 + math.exp(-(z - t))) for t in model.thetas]
        share = [a - b for a, b in zip([1, *above], [*above, 0])]
        assert abs(got[r.doc_id].severity - sum(above)) < 1e-6 and got[r.doc_id].grade == share.index(max(share))


def test_quality_scores_against_a_plain_forward_pass(spark):
    """The query's scores of whole texts, passage by passage with plain loops; they don't depend on the texts beside them."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    m = mil.fit(docs, labels)
    some = docs.select("doc_id", "text").limit(80)
    got = {r.doc_id: r.score for r in mil.score(some, m).collect()}
    for r in some.collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        x, _ = mil.passages(data, np.array([0, len(data)]))
        h = [np.tanh(((v - m.mean) / m.scale) @ m.p["W"] + m.p["b"]) for v in x]
        e = [float((np.tanh(v @ m.p["V"]) / (1 + np.exp(-(v @ m.p["U"])))) @ m.p["a"]) for v in h]
        share = np.exp(np.array(e) - max(e)) / np.exp(np.array(e) - max(e)).sum()
        z = sum(a * v for a, v in zip(share, h))
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-float(z @ m.p["c"] + m.p["c0"][0])))) < 1e-4


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(i, f"word{i} other", 7, 8, 9) for i in range(12)], "doc_id long, text string, _id int, _grade int, _y int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int").selectExpr("*", "toxic AS quality")
    assert {(r._id, r._grade, r._y) for r in toxicity.toxicity(docs, labels).collect()} == {(7, 8, 9)}
    assert {(r._id, r._grade, r._y) for r in mil.score(docs, mil.fit(docs, labels)).collect()} == {(7, 8, 9)}


def test_toxicity_on_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    told = {r.doc_id: r.toxic for r in labels.collect()}
    got = {r.doc_id: r for r in toxicity.op1(spark, SF).collect()}
    assert len(got) == docs.count()
    hit = [got[d].toxic for d, t in told.items() if t]
    miss = [got[d].toxic for d, t in told.items() if not t]
    assert np.mean(hit) > 0.9 and np.mean(miss) < 0.03


def odd(spark):
    return spark.createDataFrame([(1, None, "k"), (1, "", "k"), (2, "a " * 9, "k"), (2, "a " * 9, "k"), (None, "x" * 5000, None)], "doc_id long, text string, grade string")


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(2, 1), (1, 0), (None, 1), (2, None)]])
def test_edges(spark, labels):
    lab = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "toxic AS quality")
    d = odd(spark)
    rows = toxicity.toxicity(d, lab).collect()
    assert len(rows) == 5 and all(r.severity is not None and isinstance(r.grade, int) for r in rows)
    rows = mil.score(d, mil.fit(d, lab)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(d.limit(0), lab).count() == 0 and mil.score(d.limit(0), mil.fit(d, lab)).count() == 0


def test_telling_words_of_very_long_texts_are_learned(spark):
    # each text has 9,000 words of its own, the telling ones of the second grade are some of many
    rows = [(d, " ".join([f"n{d}x{i}" for i in range(9000)] + [f"{'bad' if d % 2 else 'good'}{'abcdefgh'[k]}" for k in range(8)])) for d in range(24)]
    m = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(d, d % 2) for d in range(24)], "doc_id long, toxic int"), "toxic")
    words = [f"bad{c}" for c in "abcdefgh"]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    ((places),) = toxicity.features(data, np.array([0, len(data)]))
    assert (m.weights[places] > 0).all()


def test_mil_gradient():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(k, 5)) for k in (1, 3, 2)]
    y, w = np.array([0.0, 1.0, 1.0]), np.array([1.0, 0.5, 2.0])
    x, first = np.concatenate(bags), np.array([0, 1, 4, 6])
    m = mil.Model(5)

    def loss():
        s = m.forward(x, first)["s"]
        return -(w * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()

    g = m.gradient(m.forward(x, first), first, y, w)
    for k in m.p:
        i = tuple(rng.integers(0, n) for n in m.p[k].shape)
        old = m.p[k][i]
        m.p[k][i] = old + 1e-5
        up = loss()
        m.p[k][i] = old - 1e-5
        down = loss()
        m.p[k][i] = old
        assert abs((up - down) / 2e-5 - g[k][i]) < 1e-5, k


def test_the_fit_reads_every_passage(spark, monkeypatch):
    texts = {d: " ".join(f"w{d}x{i}" for i in range(n)) for d, n in ((1, 64 * 100), (2, 5), (3, 64 * 33 + 1), (4, 3), (5, 700))}
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(d, d % 2) for d in texts], "doc_id long, quality int")
    told, seen = [d for d in texts if zlib.crc32(str(d).encode()) % 4 != 2], []
    monkeypatch.setattr(mil, "fit_bags", lambda bags, y, weight: seen.append(([np.array(b) for b in bags], y)))
    mil.fit(docs, labels)
    ((bags, y),) = seen
    assert 1 in told and 3 in told and y.tolist() == [d % 2 for d in told]
    for d, bag in zip(told, bags):
        data = np.frombuffer(texts[d].encode(), np.uint8)
        want = mil.passages(data, np.array([0, len(data)]))[0]
        assert bag.shape == want.shape and np.allclose(bag, want)


def test_a_step_in_parts_is_the_same_step(monkeypatch):
    rng = np.random.default_rng(3)
    bags = [rng.normal(size=(k, 5)).astype(np.float32) for k in rng.integers(1, 9, 200)]
    y = np.array([float(b[:, 0].max() > 1) for b in bags])
    one = mil.fit_bags(bags, y, np.ones(200))
    monkeypatch.setattr(mil, "PART", 7)
    two = mil.fit_bags(bags, y, np.ones(200))
    assert all(np.allclose(one.p[k], two.p[k], atol=1e-4) for k in one.p)


def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = mil.op6(spark, SF).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7)
    s = np.array([(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels])
    good, bad = s[s[:, 1] == 1, 0], s[s[:, 1] == 0, 0]
    assert (good[:, None] > bad[None, :]).mean() > 0.9
