import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import substrings


def brute(rows, match=50):
    from collections import defaultdict

    first = defaultdict(lambda: None)
    for d, t in rows:
        b = (t or "").encode()
        if d is None:
            continue
        for i in range(len(b) - match + 1):
            k = b[i : i + match]
            if first[k] is None or d < first[k]:
                first[k] = d
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if d is not None:
            for i in range(len(b) - match + 1):
                if first[b[i : i + match]] < d:
                    gone[i : i + match] = b"\x01" * match
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **ways):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/t5"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return sorted(map(tuple, substrings.op5(spark, path, **ways).collect()), key=str)


def rows_of(seed):
    rng = random.Random(seed)
    piece = ["".join(rng.choice("abé \n") for _ in range(rng.randrange(20, 200))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(piece) for _ in range(rng.randrange(0, 6)))) for i in range(60)]
    base = "".join(rng.choice("abcdefgh ") for _ in range(900))
    for i in range(40):
        t = list(base)
        for _ in range(rng.randrange(1, 9)):
            t[rng.randrange(900)] = rng.choice("xyz")
        rows.append((100 + i, "".join(t)))
    rows += [(200, "a" * 300), (201, "a" * 49), (202, "b" + "a" * 120), (203, None), (204, ""), (5, piece[0] * 2), (5, piece[0] * 2), (5, base[:200]), (None, base), (None, None), (-3, base[100:300] + "q"), (205, "\x00" * 70), (206, "c" + "\x00" * 60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("ways", [{}, {"index": 500}, {"index": 60, "few": 0}, {"hot": (1, 0.0, 3)}, {"hot": (1, 0.0, 1), "few": 2, "index": 200}])
def test_brute_force(spark, monkeypatch, ways):
    if ways:
        monkeypatch.setattr(substrings, "BUCKET_BYTES", (4000, 4000))
    rows = rows_of(3 + len(ways))
    assert run(spark, rows, **ways) == brute(rows)


def test_hot_edge(spark):
    """A passage that all documents share between texts of their own: its edges' anchors are hot."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = word(220)
    rows = [(i, word(80) + passage + word(80)) for i in range(150)]
    assert run(spark, rows, hot=(1, 0.0, 20)) == brute(rows)


def test_clashing_columns(spark):
    names = ["n", "z", "th", "spans", "codes", "rest", "kept", "bucket"]
    docs = spark.createDataFrame([(1, "ab" * 60, *range(8)), (2, "ab" * 60, *range(8, 16)), (3, None, *[None] * 8)], "doc_id long, text string, " + ", ".join(f"{x} long" for x in names))
    got = sorted(map(tuple, substrings.shortened(docs).collect()))
    assert got == [(1, "ab" * 60, *range(8)), (2, "", *range(8, 16)), (3, "", *[None] * 8)]


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def _peak(work) -> int:
    """Bytes that ``work`` holds at once beyond what stood before."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _batch():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(2000)]
    return pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(2000), pa.int64()), pa.array([0] * 2000, pa.int32())], names=["text", "doc_id", "th"])


class _NoneHot:
    value = np.zeros(0, np.uint64)


def test_anchor_memory():
    """4 MB of text are hashed in small pieces, so what a task holds is mostly the anchors found."""
    batch = _batch()
    assert _peak(lambda: [*substrings._anchor_rows(3, 50, _NoneHot)(iter([batch]))]) < 14 * batch.nbytes


def test_context_memory():
    """Contexts are cut from some texts at a time, as arrays and not as a Python value each."""
    batch = _batch()
    [texts] = substrings._compressed(iter([batch]))
    pos = np.arange(40, 1900, 18)
    codes = pa.array([(pos << 18 | 20 << 10 | 17 << 2 | substrings.OPEN).tolist()] * 2000, pa.list_(pa.int64()))
    joined = pa.RecordBatch.from_arrays([*texts.columns, codes], names=["doc_id", "th", "z", "n", "codes"])
    size = 0

    def count():
        nonlocal size
        size = sum(x.nbytes for x in substrings._context_rows(3, 50)(iter([joined])))

    assert _peak(count) < 100e6
    assert size > len(pos) * 2000 * 67


def test_anchors_are_of_the_string():
    """Equal strings have equal anchors at equal places, wherever they stand and whatever surrounds them."""
    rng = random.Random(6)
    text = "".join(rng.choice("ab ") for _ in range(3000))
    seen = {}
    for cut in (0, 1, 17, 700):
        for tail in ("", "b", "a" * 90):
            rows = [b"x" * 60, b"", b"a" * 49, (text[cut:] + tail).encode(), b"c" * 50]
            offs = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
            pos, row, h, c, _, e = substrings.anchors(np.frombuffer(b"".join(rows), np.uint8), offs)
            assert set(row.tolist()) == {0, 3, 4}
            for p, r, g, x in zip(pos.tolist(), row.tolist(), h.tolist(), e.tolist()):
                for start in range(p - (x >> 8), p - (x >> 8) + (x & 255) + 1):
                    string = rows[r][start : start + 50]
                    assert len(string) == 50
                    assert seen.setdefault(string, (p - start, g)) == (p - start, g)
