"""Operator 1: toxicity by cumulative-link ordinal regression.

P(grade <= k) = sigmoid(theta_k - w.x): one weight vector shared by ordered thresholds theta_1 < ... < theta_K-1.
x is sparse: for every distinct word (A-Z lower-cased, [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+) the word and its first
four bytes, hashed into 2**18 places. The output is the expected severity sum_k P(grade > k) and the likeliest grade.

The model is fitted on labelled rows, at most ``MAX_ROWS`` of them (those with the smallest hash of doc_id; of the
lowest and the other grades half each), by Adagrad on the driver over sparse arrays of bounded size. Scoring is one
pass over the whole texts without a shuffle.

Defined cases: a null or empty text has no features and gets the severity that the thresholds alone give; rows that
repeat a doc_id are scored each; labels with a null doc_id or grade are not learned from; without labels of two
grades at least every text has severity 0; an empty table gives no rows; output names replace clashing columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm import textarrays as ta

PLACES = 1 << 18
#: Labelled rows that the fit reads at most; a text has PLACES distinct features at most.
MAX_ROWS = 8_000
MIN_TEXTS = 3
STEPS = 150
STEM = 4


def features(data: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct hashed features of each text of a piece."""
    data = ta.LOWER[data]
    starts, ends, rows = ta.words(data, offs, ta.ALNUM)
    if len(starts):
        whole = (ta.span_hash(data, starts, ends) >> ta.U64(46)).astype(np.int64)
        stem = (ta.span_hash(data, starts, np.minimum(ends, starts + STEM)) >> ta.U64(46)).astype(np.int64)
        long = ends - starts > STEM
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if a == b:
            yield np.zeros(0, np.int64)
            continue
        # a stem is marked by another place than the word of the same bytes
        yield np.unique(np.concatenate([whole[a:b], (stem[a:b][long[a:b]] * 31 + 7) % PLACES]))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thetas: np.ndarray

    def severity(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(expected severity, likeliest grade) of linear scores."""
        if not len(self.thetas):
            return np.zeros(len(z)), np.zeros(len(z), np.int32)
        above = 1 / (1 + np.exp(-np.clip(z[:, None] - self.thetas[None, :], -40, 40)))
        edges = np.concatenate([np.ones((len(z), 1)), above, np.zeros((len(z), 1))], axis=1)
        return above.sum(axis=1), np.argmax(edges[:, :-1] - edges[:, 1:], axis=1).astype(np.int32)

    def linear(self, feats: np.ndarray) -> float:
        return float(self.weights[feats].sum())


def loss_and_gradient(w: np.ndarray, gap: np.ndarray, flat: np.ndarray, owner: np.ndarray, value: np.ndarray, grades: np.ndarray, weight: np.ndarray, l2: float) -> tuple[float, np.ndarray, np.ndarray]:
    """(negative log likelihood with its penalty, gradient by w, gradient by gap) of rows with the features ``flat`` of ``owner``."""
    levels = len(gap) + 1
    thetas = np.cumsum(np.concatenate([gap[:1], np.exp(gap[1:])]))
    z = np.bincount(owner, w[flat] * value, minlength=len(grades))
    lo = np.concatenate([[-40.0], thetas])[grades] - z
    hi = np.concatenate([thetas, [40.0]])[grades] - z
    sl, sh = 1 / (1 + np.exp(-np.clip(lo, -40, 40))), 1 / (1 + np.exp(-np.clip(hi, -40, 40)))
    sl, sh = np.where(grades > 0, sl, 0.0), np.where(grades < levels - 1, sh, 1.0)
    p = np.maximum(sh - sl, 1e-12)
    dl, dh = sl * (1 - sl), sh * (1 - sh)
    gz = weight * (dh - dl) / p
    gt = np.zeros(levels + 1)
    np.add.at(gt, grades + 1, -weight * dh / p)
    np.add.at(gt, grades, weight * dl / p)
    tail = np.cumsum(gt[1:levels][::-1])[::-1]
    gg = tail * np.concatenate([[1.0], np.exp(gap[1:])])
    gw = np.bincount(flat, gz[owner] * value, minlength=len(w)) + l2 * w
    return float(-(weight * np.log(p)).sum() + l2 / 2 * (w * w).sum()), gw, gg


def fit_arrays(rows: list[np.ndarray], grades: np.ndarray, steps: int = STEPS, l2: float = 1e-4, rate: float = 0.2) -> Model:
    """Adagrad on the negative log likelihood of the cumulative link model; grades are 0..K-1.

    A feature's value is the log ratio of its frequency above and in the lowest grade, so that the thousands of
    indifferent words of a long text don't drown a few telling ones; features of fewer than MIN_TEXTS texts are left out.
    """
    levels = int(grades.max()) + 1 if len(grades) else 0
    if levels < 2:
        return Model(np.zeros(PLACES), np.zeros(0))
    count = np.array([len(r) for r in rows])
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), count)
    up = (grades > 0)[owner]
    high, low = np.bincount(flat[up], minlength=PLACES), np.bincount(flat[~up], minlength=PLACES)
    ratio = np.log((high + 1) / ((grades > 0).sum() + 2)) - np.log((low + 1) / ((grades == 0).sum() + 2))
    told = (high + low >= MIN_TEXTS) & (np.abs(ratio) > 0.5)
    keep = told[flat]
    flat, owner = flat[keep], owner[keep]
    places, flat = np.unique(flat, return_inverse=True)
    value = ratio[places][flat]
    # the lowest grade and the rest weigh the same, and so do the grades of the rest
    size = np.bincount(grades, minlength=levels)
    weight = np.where(grades == 0, 1.0, 1.0 / max(1, (size[1:] > 0).sum())) / size[grades]
    weight /= weight.sum()
    w, gap = np.full(len(places), 0.1), np.zeros(levels - 1)  # gap: the first threshold, then the logarithms of the gaps
    hw, hg = np.full(len(w), 1e-8), np.full(len(gap), 1e-8)
    for _ in range(steps):
        _, gw, gg = loss_and_gradient(w, gap, flat, owner, value, grades, weight, l2)
        hw += gw * gw
        hg += gg * gg
        w -= rate * gw / np.sqrt(hw)
        gap -= rate * gg / np.sqrt(hg)
    out = np.zeros(PLACES)
    out[places] = w * ratio[places]
    return Model(out, np.cumsum(np.concatenate([gap[:1], np.exp(gap[1:])])))


def fit(docs: DataFrame, labels: DataFrame, grade: str, max_rows: int = MAX_ROWS) -> Model:
    """The model of ``labels`` (doc_id, grade) joined with the texts of ``docs``."""
    told = labels.where(F.col(grade).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_id"), F.col(grade).cast("int").alias("_grade"))
    low = told.agg(F.min("_grade")).first()[0]
    if low is None:
        return Model(np.zeros(PLACES), np.zeros(0))
    order = F.xxhash64("_id")
    # at most max_rows ids: a top-k by hash in each half, so the broadcast side is bounded
    part = [told.where(c).orderBy(order, "_id").limit(max_rows // 2) for c in (F.col("_grade") == low, F.col("_grade") > low)]
    chosen = F.broadcast(part[0].unionByName(part[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.pieces(batch, "text"):
                got = [*features(data, offs)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([x.astype(np.int32) for x in got], pa.list_(pa.int32()))], names=["grade", "x"])

    # only these two columns of docs take part, so no other name of theirs can clash
    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).select("_grade", "text").mapInArrow(ta.task(run), "grade int, x array<int>").toArrow()
    if not len(rows):
        return Model(np.zeros(PLACES), np.zeros(0))
    grades = rows["grade"].to_numpy()
    levels, grades = np.unique(grades, return_inverse=True)
    return fit_arrays([np.asarray(x.values, np.int64) for x in rows["x"]], grades)


def score(docs: DataFrame, model: Model, severity: str = "severity", grade: str = "grade") -> DataFrame:
    """``docs`` with the expected severity (double) and the likeliest grade (int) of each whole text."""
    told = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB of weights, whatever the data
    rest = [c for c in docs.columns if c not in (severity, grade)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = told.value
        for batch in batches:
            z = [m.linear(x) for lo, hi, data, offs in ta.pieces(batch, "text") for x in features(data, offs)]
            s, g = m.severity(np.array(z, float))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array(g, pa.int32())], names=[*rest, severity, grade])

    schema = T.StructType([*docs.select(rest).schema.fields, T.StructField(severity, T.DoubleType()), T.StructField(grade, T.IntegerType())])
    return docs.select(rest).mapInArrow(ta.task(run), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with severity and grade, learned from ``labels.toxic``."""
    return score(docs, fit(docs, labels, "toxic"))


def op1(spark, sf_dir: str) -> DataFrame:
    """doc_id, severity, grade, toxic (grade above the lowest) of every document."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = toxicity(docs.select("doc_id", "text"), labels)
    return got.select("doc_id", "severity", "grade", (F.col("grade") > 0).alias("toxic"))
