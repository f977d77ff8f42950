import hashlib
import re

from plumbline.llm import decontam

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOW))


def brute(docs, items, span=13):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            if not v:
                continue
            n = min(span, len(v))
            keys = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in keys:
                    hit |= {*range(i, i + n)}
                    found.add(item)
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    d.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/t3/documents.parquet")
    b.write.mode("overwrite").parquet(path.replace("documents", "benchmark"))
    return sorted(map(tuple, decontam.op3(spark, path.rpartition("/")[0]).collect()), key=str)


ITEM = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, ITEM), (2, "Short Item é9"), (3, None), (4, ""), (5, " ".join(f"w{i}" for i in range(5, 19))), (10, "solo"), (1, "x y z " * 9), (None, "p q r")]
DOCS = [
    (1, ITEM), (2, "pre " + ITEM.replace(" ", ", ") + " post " * 400), (3, None), (4, ""), (5, "aa short ITEM é9 bb"), (5, "nothing here"), (5, "nothing here"),
    (6, " ".join(f"w{i}" for i in range(12))), (7, " ".join(f"w{i}" for i in range(3, 16)) + " " + " ".join(f"w{i}" for i in range(4, 17))), (8, "solo-solo Solo"), (9, "x y z " * 5), (None, ITEM), (11, "p q r"),
]


def test_brute_force(spark):
    assert run(spark, DOCS, ITEMS) == brute(DOCS, ITEMS)


def test_shuffle_path(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_HASHES", -1)
    assert run(spark, DOCS, ITEMS) == brute(DOCS, ITEMS)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, ITEM, 4, 5, 6), (2, "quite another text", 7, 8, 9), (None, ITEM, 1, 1, 1)], "doc_id long, text string, _id int, key int, row int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert [tuple(r) for r in decontam.clean(docs, items).collect()] == [(2, "quite another text", 7, 8, 9)]


def test_empty(spark):
    assert run(spark, [], ITEMS) == []
    assert run(spark, DOCS, []) == brute(DOCS, [])


def test_winnow_guarantee():
    import numpy as np

    rng = np.random.default_rng(1)
    shared = rng.integers(0, 5, 13).astype(np.uint64)
    a = np.concatenate([rng.integers(0, 5, 40).astype(np.uint64), shared, rng.integers(0, 5, 40).astype(np.uint64)])
    b = np.concatenate([rng.integers(0, 5, 7).astype(np.uint64), shared])
    assert {*decontam.fingerprints(a, 13)[1].tolist()} & {*decontam.fingerprints(b, 13)[1].tolist()}
