"""Operator 6: document quality by gated-attention multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words. Each passage becomes a vector (hashed words and measures of its
style), an encoder maps it to h = tanh(W x + b), gated attention a.(tanh(V h) * sigmoid(U h)), a softmax over the
text's passages, weighs the h, and the weighted sum is scored by a logistic unit. Only document labels are needed:
attention learns which passages decide.

Encoder, attention and score are fitted together by Adam on the driver, on at most ``MAX_ROWS`` labelled rows
(smallest hash of doc_id, half of each label; weights restore the labels' true shares) with every passage of each. Their
vectors are stored, then kept on the driver's local disk, from which each mini-batch reads its bags; rows come to the
driver one partition at a time, and a step takes a mini-batch in parts of ``PART`` passages or one bag. Scoring reads
every passage of the whole texts in one pass without a shuffle. The model's size is fixed.

Defined cases: a null or empty text is one passage without words and gets a score like any other; repeated rows are
scored each; null labels or doc_ids are not learned from; without both labels the score is the only label's value, or
0.5 without any; an empty table gives no rows; output names replace clashing columns.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm import textarrays as ta
from plumbline.sources.shared import drop_stored, stored

PASSAGE = 64
BINS = 128
HIDDEN, GATE = 24, 12
MAX_ROWS = 4_000
#: Passages that one part of a mini-batch has at most, unless a single bag has more.
PART = 1 << 14
EPOCHS = 8
KEEP = 0.7

_MARKS = [ta.table("#*$%&|<>", False), ta.table("0123456789", False), ta.table("ABCDEFGHIJKLMNOPQRSTUVWXYZ", False), ta.table(".,;:!?", False), ta.table("", True)]


def passages(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, offsets of each text's passages) of a piece; every text has one passage at least."""
    starts, ends, rows = ta.words(data, offs, ta.NONSPACE)
    n = np.diff(rows)
    many = np.maximum(1, -(-n // PASSAGE))
    first = np.concatenate([[0], np.cumsum(many)])
    style = np.zeros((first[-1], len(_MARKS) + 6), np.float32)
    bins = np.zeros((first[-1], BINS), np.float32)
    if len(starts):
        doc = np.repeat(np.arange(len(n)), n)
        at = first[doc] + (np.arange(len(starts)) - rows[doc]) // PASSAGE
        size = np.bincount(at, minlength=first[-1])
        some = np.maximum(size, 1)
        lens = ends - starts
        chars = np.maximum(np.bincount(at, lens, first[-1]), 1)
        for i, mark in enumerate(_MARKS):
            total = np.concatenate([[0], np.cumsum(mark[data])])
            style[:, i] = np.bincount(at, total[ends] - total[starts], first[-1]) / chars
        wh = ta.span_hash(ta.LOWER[data], starts, ends)
        pair = ta.mix(wh[:-1] * ta.U64(3) + wh[1:])
        k = len(_MARKS)
        style[:, k] = chars / some / 10
        style[:, k + 1] = np.bincount(at, (lens <= 2), first[-1]) / some
        style[:, k + 2] = _distinct(at, wh, first[-1]) / some
        same = np.flatnonzero(doc[1:] == doc[:-1])  # a pair lies in one text, so a score never depends on the texts beside it
        style[:, k + 3] = _distinct(at[same], pair[same], first[-1]) / some
        style[:, k + 4] = np.bincount(at, lens == 1, first[-1]) / some
        style[:, k + 5] = size / PASSAGE
        cell = at * BINS + (wh >> ta.U64(57)).astype(np.int64)
        bins = np.sqrt(np.bincount(cell, minlength=first[-1] * BINS).reshape(-1, BINS) / some[:, None]).astype(np.float32)
    return np.concatenate([style, bins], axis=1), first


def _distinct(group: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each group; ``group`` ascends."""
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
    return np.bincount(g[new], minlength=n)


class Model:
    """The parameters and their forward pass."""

    def __init__(self, width: int, seed: int = 7):
        r = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(width, np.float32), np.ones(width, np.float32)
        self.p = {
            "W": r.normal(0, 0.15, (width, HIDDEN)), "b": np.zeros(HIDDEN), "V": r.normal(0, 0.3, (HIDDEN, GATE)), "U": r.normal(0, 0.3, (HIDDEN, GATE)),
            "a": r.normal(0, 0.3, GATE), "c": r.normal(0, 0.3, HIDDEN), "c0": np.zeros(1),
        }
        self.constant: float | None = None

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        p, own = self.p, np.repeat(np.arange(len(first) - 1), np.diff(first))
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (v * u) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[own])
        alpha = e / np.add.reduceat(e, first[:-1])[own]
        z = np.add.reduceat(alpha[:, None] * h, first[:-1], axis=0)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["c0"], -40, 40)))
        return {"x": x, "own": own, "h": h, "v": v, "u": u, "alpha": alpha, "z": z, "s": s}

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.full(len(first) - 1, self.constant) if self.constant is not None else self.forward(x, first)["s"]

    def gradient(self, f: dict, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        p, own = self.p, f["own"]
        ds = weight * (f["s"] - y)
        dz = ds[:, None] * p["c"]
        dalpha = (dz[own] * f["h"]).sum(1)
        de = f["alpha"] * (dalpha - np.add.reduceat(f["alpha"] * dalpha, first[:-1])[own])
        dg = de[:, None] * p["a"]
        dv, du = dg * f["u"] * (1 - f["v"] ** 2), dg * f["v"] * f["u"] * (1 - f["u"])
        dh = f["alpha"][:, None] * dz[own] + dv @ p["V"].T + du @ p["U"].T
        dh *= 1 - f["h"] ** 2
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dv, "U": f["h"].T @ du, "a": (f["v"] * f["u"]).T @ de, "c": f["z"].T @ ds, "c0": ds.sum(keepdims=True)}


def _scale(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(mean, deviation) of all passages, bag by bag."""
    n = sum(map(len, bags))
    mean = sum(b.sum(0, dtype=np.float64) for b in bags) / n
    var = sum(((b - mean) ** 2).sum(0) for b in bags) / n
    return mean.astype(np.float32), np.sqrt(var).astype(np.float32)


def _parts(part: np.ndarray, bags: list[np.ndarray]) -> Iterator[np.ndarray]:
    """``part`` cut where its bags pass PART passages; a bag is never cut."""
    size = np.array([len(bags[j]) for j in part])
    lo = 0
    while lo < len(part):
        hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(size[lo:]), PART, "right")))
        yield part[lo:hi]
        lo = hi


def fit_bags(bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, rate: float = 0.004, decay: float = 1e-4, seed: int = 7) -> Model:
    """Adam over mini-batches of 128 bags."""
    model = Model(bags[0].shape[1] if bags else len(_MARKS) + 6 + BINS, seed)
    if len(set(y.tolist())) < 2:
        model.constant = float(y[0]) if len(y) else 0.5
        return model
    model.mean, model.scale = _scale(bags)
    model.scale = model.scale + np.float32(1e-3)
    rng, step = np.random.default_rng(seed), 0
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    s = {k: np.zeros_like(v) for k, v in model.p.items()}
    weight = weight / weight.mean()
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), 128):
            part = order[i : i + 128]
            total = {k: np.zeros_like(v) for k, v in model.p.items()}
            for own in _parts(part, bags):
                first = np.concatenate([[0], np.cumsum([len(bags[j]) for j in own])])
                f = model.forward(np.concatenate([bags[j] for j in own]), first)
                for k, g in model.gradient(f, first, y[own], weight[own] / len(part)).items():
                    total[k] += g
            step += 1
            for k, g in total.items():
                g = g + decay * model.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                lr = rate * (1 - epoch / epochs)
                model.p[k] = model.p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """The model of the labelled rows that aren't held out."""
    told = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    told = told.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
    share = {r["_y"]: r["count"] for r in told.groupBy("_y").count().collect()}
    order = F.xxhash64("_id")
    part = [told.where(F.col("_y") == v).orderBy(order, "_id").limit(max_rows // 2) for v in (0, 1)]
    chosen = F.broadcast(part[0].unionByName(part[1]))  # at most max_rows ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.pieces(batch, "text"):
                x, first = passages(data, offs)
                bags = [x[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(bags, pa.binary())], names=["id", "y", "x"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = stored(docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).select("doc_id", "_y", "text").mapInArrow(run, f"id {kind}, y int, x binary"), "bags")
    width = len(_MARKS) + 6 + BINS
    with tempfile.TemporaryFile() as file:
        told_rows, at = [], 0
        for r in rows.toLocalIterator():
            file.write(r["x"])
            n = len(r["x"]) // (4 * width)
            told_rows.append((r["id"], at, n, r["y"]))
            at += n
        file.flush()
        drop_stored(rows)
        told_rows.sort(key=lambda r: r[0])
        vectors = np.memmap(file, np.float32, "r", shape=(at, width)) if at else np.zeros((0, width), np.float32)
        y = np.array([r[3] for r in told_rows], float)
        taken = {v: max(1, int((y == v).sum())) for v in (0, 1)}
        weight = np.array([share.get(int(v), 1) / taken[int(v)] for v in y])
        return fit_bags([vectors[a : a + n] for _, a, n, _ in told_rows], y, weight)


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1, higher: label 1 likelier) of each whole text."""
    told = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [np.zeros(0)]
            for _lo, _hi, data, offs in ta.pieces(batch, "text"):
                got.append(told.value.score(*passages(data, offs)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(got))], names=[*rest, out])

    schema = T.StructType([*docs.select(rest).schema.fields, T.StructField(out, T.DoubleType())])
    return docs.select(rest).mapInArrow(run, schema)


def op6(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = score(docs.select("doc_id", "text"), fit(docs, labels))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= KEEP, 1).otherwise(0).alias("predicted"))
