import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from plumbline.llm import resample

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def features(text):
    words = WORD.findall((text or "").encode().translate(LOWER))
    return len(words), [zlib.crc32(b" ".join(words[i : i + k])) % 10_000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target):
    """The contract on whole texts, without lines; {position: (doc_id, n_features, weight, score, rank)}."""
    own, wanted = [features(t) for _, t in docs], [features(t) for t in target]
    s, t = Counter(b for _, x in own for b in x), Counter(b for _, x in wanted for b in x)
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)}
    rows = []
    for (i, _), (n, x) in zip(docs, own):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in x)
        rows.append([i, len(x), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    drawn = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(drawn[: 5 * len(drawn) // 100]):
        r[4] = k + 1
    return sorted(repr(tuple(r[:5])) for r in rows)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = resample.op12(spark, sf).collect()
    assert sorted(repr((r.doc_id, r.n_features, r.weight, r.score, r.rank)) for r in got) == brute(docs, target)


def test_lines_and_crossings_hold_each_feature_once():
    for text in ["", "\n\n", "one", "one\ntwo", "one\n\n,\ntwo three\nfour\nfive six seven\n", "A b\nC\nd\n\ne f g h\ni", "é\u0085x\r\ny\x00z`w"]:
        lines = resample.lines_of(text)
        parts = [b for x in lines for b in resample.line_buckets(x)] + list(resample.crossing_buckets(lines))
        assert sorted(parts) == sorted(features(text)[1]), text
    assert resample.lines_of(None) == []


def test_bodies_round_trip():
    import numpy as np

    for x in ([], [0], [9999, 0, 0, 5, 300, 300]):
        assert resample._from_body(resample._body(np.array(x, np.int64))).tolist() == sorted(x)


def test_distinct_lines_are_counted_once(spark):
    """A line that many documents share has one row of features, with all its occurrences."""
    df = spark.createDataFrame([(i, f"shared line, of All\nown {i}\nShared line of all") for i in range(50)], "doc_id long, text string").repartition(4)
    own = resample.Counted(df, "doc_id", "text", resample.BUCKETS)
    found = own.lines.orderBy(F.col("n").desc()).collect()
    assert len(found) == 51 and found[0].n == 100 and all(r.n == 1 for r in found[1:])
    assert int(own.counts.sum()) == sum(len(features(r.text)[1]) for r in df.collect())
    own.drop()


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(resample, "HELD_BYTES", 0)
    many = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, "\n . \n"), (4, many), (4, many), (None, many), (5, many.replace(" ", "\n")), (6, "w1 w2")] + [(100 + i, many + f"\nq{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("row", "id", "weight", "rank", "lines", "n")})
    target = spark.createDataFrame([("x", "w1 w2 w3"), ("y", None)], "item_id string, text string")
    out = resample.ranked(resample.score(docs, target), percent=50).collect()
    assert len(out) == len(rows)
    ranks = sorted(r.rank for r in out if r.rank is not None)
    assert ranks == list(range(1, 32 + 1)) and all(r.n_words >= 20 for r in out if r.rank)
    assert {(r.n_features, r.weight) for r in out if r.id in (1, 2, 3)} == {(0, 0)}
    by_rank = [r.score for r in sorted((r for r in out if r.rank), key=lambda r: r.rank)]
    assert by_rank == sorted(by_rank, reverse=True) and min(by_rank) >= max(r.score for r in out if r.rank is None and r.n_words >= 20)
    assert len({r.weight for r in out if r.id in (4, 5)}) == 1  # newlines are no feature
    empty = resample.ranked(resample.score(docs.limit(0), target))
    assert empty.collect() == []
    none = resample.ranked(resample.score(docs, target.limit(0))).collect()
    assert len(none) == len(rows)
