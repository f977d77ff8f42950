"""Operator 8: quality rules with n-gram perplexity bands.

A modified Kneser-Ney model of byte n-grams (order ``ORDER``) is counted by Spark over the whole texts, for each
language and each of ``FOLDS`` folds of its texts; a text's fold is a hash of the text, and the text is scored by the
model of the other folds' texts, so that neither its own n-grams nor those of its exact copies count in its favour.
Tasks pre-aggregate, one shuffle sums. Continuation counts, discounts (D1, D2, D3+ of each model and order), contexts
and interpolated probabilities are joins and groupings of those tables, whose size is that of the distinct n-grams, not
of the corpus. The result is stored in sorted arrays of 64-bit hashes with a directory of their leading bits, which
tasks search; an n-gram that isn't stored backs off. No n-gram is pruned: models of up to ``MAX_GRAMS`` n-grams travel
whole to every task; larger ones are joined with the distinct n-grams of each lot of ``LOT_BYTES`` of text, order by
order, and a lot's texts meet the sorted arrays of that lot's n-grams. Both ways give the same scores.

A text's perplexity is exp of minus the mean log probability of its bytes (A-Z lower-cased, white space as blanks).
Each language gets a lower and an upper band of the log perplexities of texts that pass the base rules: the median less
``LOWER`` times the median deviation of the texts below it, and plus ``UPPER`` times that of the texts above it. A short
text's mean scatters more, so deviations are counted, and bands widened, by sqrt(1 + SCATTER / bytes). Texts outside
are rejected.

Equal lines and equal runs of eight words are told by 64-bit hashes of the whole line or run; their bytes aren't compared.

Defined cases: a null or empty text has no words, fails the base rules and has perplexity null; a null language is a
language of its own; a language without a text in the other folds is scored by the uniform distribution; repeated rows
are judged each; a side whose deviation is zero rejects only texts beyond MIN_WIDTH; an empty table gives no rows; other
columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm import textarrays as ta
from plumbline.sources.shared import drop_stored, stored

ORDER = 5
FOLDS = 2
#: Bound of the n-grams of all orders that are broadcast (some 24 bytes each), and text of a lot beyond it.
MAX_GRAMS = 6_000_000
LOT_BYTES = 8 << 20
#: Band widths in median deviations of their side, and the width in natural-log perplexity of a side without deviation.
LOWER, UPPER = 6.0, 5.0
#: Bytes of text at which the scatter of a mean is as large as the texts' own differences.
SCATTER = 4_000
MIN_WIDTH = 0.25
#: Log perplexities are counted in steps of 1 / STEP to find medians without gathering them.
STEP = 1_000
REPEAT = 8

_SYMBOL = ta.table("#*$%&|<>", False)
_LEAD = (np.arange(256) & 0xC0) != 0x80
_TEXT = ta.LOWER.copy()
_TEXT[[9, 10, 11, 12, 13]] = 32


def grams(data: np.ndarray, offs: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The ``order`` bytes that end at each byte, packed; bytes before a text's start are zero."""
    data = _TEXT[data].astype(np.int64)
    pos = np.arange(len(data)) - np.repeat(offs[:-1], np.diff(offs))
    out = data.copy()
    for k in range(1, order):
        out[k:] |= np.where(pos[k:] >= k, data[:-k], 0) << (8 * k)
    return out


def _counted(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict = {}
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def merge():
            k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            c = np.bincount(inverse, np.concatenate(counts), len(k)).astype(np.int64)
            keys[:], counts[:] = [k], [c]

        def out():
            names = np.array([*langs], dtype=object)
            where = keys[0] >> (8 * order)
            return pa.RecordBatch.from_arrays([pa.array(names[where] if len(names) else [], pa.string()), pa.array(keys[0] & ((1 << 8 * order) - 1)), pa.array(counts[0])], names=["lang", "g", "c"])

        for batch in batches:
            own = batch.column(1).to_pylist()
            for lo, hi, data, offs in ta.pieces(batch, "text"):
                ids = np.array([langs.setdefault(x, len(langs)) for x in own[lo:hi]], np.int64)
                k, c = np.unique(grams(data, offs, order) | np.repeat(ids << (8 * order), np.diff(offs)), return_counts=True)
                keys.append(k)
                counts.append(c)
                if sum(map(len, keys)) > 2_000_000:
                    merge()
                    if len(keys[0]) > 1_000_000:
                        yield out()
                        keys[:], counts[:] = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        merge()
        if len(keys[0]):
            yield out()

    return run


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, g, c): how often each packed n-gram of ``order`` bytes occurs, by language, over all texts."""
    rows = docs.select("text", F.coalesce("lang", F.lit("")).alias("lang")).mapInArrow(_counted(order), "lang string, g long, c long")
    return rows.groupBy("lang", "g").agg(F.sum("c").alias("c"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(n, lang, g, c, p, context_total, gamma): interpolated modified Kneser-Ney probabilities of all orders.

    p is the probability of the last byte after the others; gamma is the back-off weight of g's context.
    """
    levels = {order: stored(counts, "grams")}  # written once, so that the texts are counted once
    for n in range(order - 1, 0, -1):
        mask = (1 << 8 * n) - 1
        levels[n] = stored(levels[n + 1].groupBy("lang", F.col("g").bitwiseAND(F.lit(mask)).alias("g")).agg(F.count("*").alias("c")), "grams")
    below, out = None, None
    for n in range(1, order + 1):
        t = levels[n]
        of = t.groupBy("lang").agg(*[F.sum(F.when(F.col("c") == i, 1).otherwise(0)).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))

        def discount(i: int, y: Column = y) -> Column:
            d = F.lit(float(i)) - (i + 1) * y * F.col(f"n{i + 1}") / F.greatest(F.col(f"n{i}"), F.lit(1.0))
            return F.when((F.col(f"n{i}") > 0) & (F.col(f"n{i + 1}") > 0) & (d > 0) & (d < i), d).otherwise(F.lit(0.5 * i if i < 3 else 1.5)).alias(f"d{i}")

        of = of.select("lang", *[discount(i) for i in (1, 2, 3)])
        t = t.join(of, "lang")  # a row for each model
        t = t.withColumn("d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))).withColumn("h", F.shiftright("g", 8))
        ctx = t.groupBy("lang", "h").agg(F.sum("c").cast("double").alias("total"), (F.sum("d") / F.sum("c")).alias("gamma"))
        t = t.join(ctx, ["lang", "h"])
        if below is None:
            lower = F.lit(1 / 256)
        else:
            t = t.withColumn("s", F.col("g").bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1)))
            t = t.join(below.select("lang", F.col("g").alias("s"), F.col("p").alias("lower")), ["lang", "s"])
            lower = F.col("lower")
        below = stored(t.select(F.lit(n).alias("n"), "lang", "g", "c", ((F.col("c") - F.col("d")) / F.col("total") + F.col("gamma") * lower).alias("p"), "gamma"), f"kn{n}")
        out = below if out is None else out.unionByName(below)
    for t in levels.values():
        drop_stored(t)
    return out


class Sorted:
    """Ascending 64-bit hashes with their values; a directory tells where the hashes of each leading bits begin."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        self.keys, i = np.unique(key, return_index=True)
        self.values = np.append(value[i], 0).astype(np.float32)
        self.shift = ta.U64(64 - max(1, len(self.keys).bit_length()))
        edges = np.arange(1 << (64 - int(self.shift)), dtype=ta.U64) << self.shift
        self.first = np.searchsorted(self.keys, edges).astype(np.int32)
        self.keys = np.append(self.keys, ~ta.U64(0))

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hit, value or zero) of each key."""
        i = self.first[(key >> self.shift).astype(np.int64)].astype(np.int64)
        less = np.flatnonzero(self.keys[i] < key)
        while len(less):
            i[less] += 1
            less = less[self.keys[i[less]] < key[less]]
        hit = (self.keys[i] == key) & (i < len(self.keys) - 1)
        return hit, np.where(hit, self.values[i], np.float32(0))


class Arrays:
    """Sorted hashes of n-grams with log probabilities, and of contexts with log back-off weights, by order."""

    def __init__(self, order: int):
        self.order, self.gram, self.context = order, {}, {}

    @staticmethod
    def key(lang: np.ndarray, g: np.ndarray) -> np.ndarray:
        return ta.mix(lang ^ ta.mix(g.astype(ta.U64)))

    def log_p(self, lang: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Log probability of each packed n-gram; what isn't stored backs off to the order below."""
        out, left = np.zeros(len(g)), np.arange(len(g))
        for n in range(self.order, 0, -1):
            gn = g[left] & ((1 << 8 * n) - 1)
            hit, value = self.gram[n].find(self.key(lang[left], gn))
            out[left[hit]] += value[hit]
            left = left[~hit]
            if not len(left):
                return out
            _, gamma = self.context[n].find(self.key(lang[left], gn[~hit] >> 8))
            out[left] += gamma
        out[left] += np.log(1 / 256)
        return out


def lang_hash(name: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def _codes(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(language hashes, n-grams) of a table with lang and g."""
    if not len(table):
        return np.zeros(0, ta.U64), np.zeros(0, np.int64)
    names = table["lang"].combine_chunks().dictionary_encode()
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    codes = np.array([lang_hash(x) for x in names.dictionary.to_pylist()], ta.U64)[names.indices.to_numpy()]
    return codes, table["g"].to_numpy()


def sorted_arrays(model: DataFrame, order: int = ORDER) -> Arrays:
    """The whole model as arrays."""
    out = Arrays(order)
    for n in range(1, order + 1):
        got = model.where(F.col("n") == n).select("lang", "g", "p", "gamma").toArrow().combine_chunks()
        codes, g = _codes(got)
        out.gram[n] = Sorted(Arrays.key(codes, g), np.log(got["p"].to_numpy()))
        out.context[n] = Sorted(Arrays.key(codes, g >> 8), np.log(got["gamma"].to_numpy()))
    return out


def measures(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text of a piece."""
    starts, ends, rows = ta.words(data, offs, ta.NONSPACE)
    n = np.diff(rows)
    lead = np.concatenate([[0], np.cumsum(_LEAD[data])])
    doc = np.repeat(np.arange(len(n)), n)
    chars = np.bincount(doc, lead[ends] - lead[starts], len(n)).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    symbols = total[offs[1:]] - total[offs[:-1]]
    lines, repeats = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    if len(starts):
        wh = ta.gram_hash(ta.span_hash(data, starts, ends), REPEAT)
        cuts = np.flatnonzero(data == 10)
        for d in range(len(n)):
            a, b = rows[d], rows[d + 1]
            if a == b:
                continue
            own = wh[a : max(a, b - REPEAT + 1)]
            if len(own) > 1:
                order = np.argsort(own, kind="stable")
                same = own[order][1:] == own[order][:-1]
                if same.any():
                    twice = np.zeros(b - a + 1, np.int64)
                    at = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
                    np.add.at(twice, at, 1)
                    np.add.at(twice, at + REPEAT, -1)
                    repeats[d] = (np.cumsum(twice) > 0).sum()
            lo, hi = np.searchsorted(cuts, [offs[d], offs[d + 1]])
            if hi > lo:
                begin = np.concatenate([[offs[d]], cuts[lo:hi] + 1])
                end = np.concatenate([cuts[lo:hi], [offs[d + 1]]])
                some = np.searchsorted(starts, begin) < np.searchsorted(starts, end)
                lh = ta.span_hash(data[offs[d] : offs[d + 1]], begin[some] - offs[d], end[some] - offs[d])
                lines[d] = len(lh) - len(np.unique(lh))
    return [n.astype(np.int64), chars, symbols.astype(np.int64), lines, repeats]


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _scored(batch: pa.RecordBatch, log_p, order: int) -> pa.RecordBatch:
    """doc_id, lang, the measures and the log perplexity of a batch with text, doc_id, lang and model."""
    models = batch.column(3).to_pylist()
    code = {x: lang_hash(x) for x in set(models)}
    got: list[list] = [[] for _ in range(7)]
    for lo, hi, data, offs in ta.pieces(batch, "text"):
        size = np.diff(offs)
        model = np.repeat(np.array([code[x] for x in models[lo:hi]], ta.U64), size)
        total = np.bincount(np.repeat(np.arange(hi - lo), size), log_p(model, grams(data, offs, order)), hi - lo)
        for x, y in zip(got, [*measures(data, offs), size, np.where(size > 0, -total / np.maximum(size, 1), np.nan)]):
            x.append(y)
    cols = [np.concatenate(x) if x else np.zeros(0) for x in got]
    arr = [pa.array(x.astype(np.int64)) for x in cols[:6]] + [pa.array(cols[6], from_pandas=True)]
    return pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *arr], names=["doc_id", "lang", *NAMES, "n_bytes", "log_perplexity"])


def score_with_arrays(docs: DataFrame, arrays: Arrays, schema: str) -> DataFrame:
    """Scores by models that every task holds whole."""
    told = docs.sparkSession.sparkContext.broadcast(arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _scored(batch, told.value.log_p, told.value.order)

    return docs.mapInArrow(run, schema)


def log_probabilities(asked: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """(lang, g, lp) of the distinct ``asked`` (lang, g), backed off order by order through joins."""
    left, out = asked.select("lang", "g", F.col("g").alias("s"), F.lit(0.0).alias("more")), None
    for n in range(order, 0, -1):
        level = model.where(F.col("n") == n)
        met = stored(left.join(level.select("lang", F.col("g").alias("s"), "p"), ["lang", "s"], "left"), "met")
        hit = met.where("p IS NOT NULL").select("lang", "g", (F.col("more") + F.log("p")).alias("lp"))
        out = hit if out is None else out.unionByName(hit)
        weight = level.groupBy("lang", F.shiftright("g", 8).alias("h")).agg(F.log(F.first("gamma")).alias("w"))
        miss = met.where("p IS NULL").select("lang", "g", "s", "more", F.shiftright("s", 8).alias("h")).join(weight, ["lang", "h"], "left")
        left = miss.select("lang", "g", F.col("s").bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1)).alias("s"), (F.col("more") + F.coalesce("w", F.lit(0.0))).alias("more"))
    return out.unionByName(left.select("lang", "g", (F.col("more") + F.lit(float(np.log(1 / 256)))).alias("lp")))


def _in_lots(most: int):
    """Rows with the number of their lot: a task's next rows of ``most`` bytes of text, or one row of more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lot, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            own = []
            for size in pc.fill_null(pc.binary_length(batch.column(0)), 0).to_pylist():
                lot, held = (lot, held + size) if held + size <= most else (lot + 1, size)
                own.append(lot)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int64())], names=[*batch.schema.names, "lot"])

    return run


def score_by_lots(docs: DataFrame, model: DataFrame, order: int, schema: str, lot_bytes: int) -> DataFrame:
    """Scores by models of any size. Rows are stored with their lot, so lots are the same whenever a task is run again."""
    lots = stored(docs.mapInArrow(_in_lots(lot_bytes), T.StructType([*docs.schema.fields, T.StructField("lot", T.LongType())])), "lots")

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            models, lot = batch.column(3).to_pylist(), batch.column(4).to_numpy()
            for lo, hi, data, offs in ta.pieces(batch, "text"):
                found = grams(data, offs, order)
                for i, x in {(int(lot[r]), models[r]) for r in range(lo, hi)}:
                    own = np.array([lot[r] == i and models[r] == x for r in range(lo, hi)])
                    g = np.unique(found[np.repeat(own, np.diff(offs))])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), i)), pa.array([x] * len(g), pa.string()), pa.array(g)], names=["lot", "lang", "g"])

    def score(texts: pa.Table, slice_: pa.Table) -> pa.Table:
        codes, g = _codes(slice_)
        table = Sorted(Arrays.key(codes, g), slice_["lp"].to_numpy())
        batches = texts.select(["text", "doc_id", "lang", "model"]).to_batches()
        kind = pa.schema([texts.schema.field("doc_id"), ("lang", pa.string()), *[(x, pa.int64()) for x in (*NAMES, "n_bytes")], ("log_perplexity", pa.float64())])
        return pa.Table.from_batches([_scored(x, lambda lang, g: table.find(Arrays.key(lang, g))[1], order) for x in batches], kind)

    asked = stored(lots.mapInArrow(wanted, "lot long, lang string, g long").distinct(), "asked")
    told = asked.join(log_probabilities(asked.select("lang", "g").distinct(), model, order), ["lang", "g"])
    return lots.groupBy("lot").cogroup(told.groupBy("lot")).applyInArrow(score, schema)


def judge(docs: DataFrame, lower: float = LOWER, upper: float = UPPER, order: int = ORDER, most: int = MAX_GRAMS, folds: int = FOLDS, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """doc_id, lang, the base measures, base_failed, log_perplexity, low, high, kept of every row of ``docs``."""
    lang, fold = F.coalesce("lang", F.lit("")), F.pmod(F.xxhash64("text"), F.lit(folds))
    # with two folds a model is that of the other fold; with one it is that of all texts
    texts = docs.select("text", "doc_id", lang.alias("lang"), F.concat((F.lit(folds - 1) - fold).cast("string"), F.lit(":"), lang).alias("model"))
    model = kneser_ney(count_grams(docs.select("text", F.concat(fold.cast("string"), F.lit(":"), lang).alias("lang")), order), order)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, lang string, " + ", ".join(f"{x} long" for x in (*NAMES, "n_bytes")) + ", log_perplexity double"
    whole = model.count() <= most
    scored = stored(score_with_arrays(texts, sorted_arrays(model, order), schema) if whole else score_by_lots(texts, model, order, schema, lot_bytes), "scored")
    drop_stored(model)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    wide = scored.join(bands(scored.where("NOT base_failed"), lower, upper), "lang", "left")
    wide = wide.withColumn("low", F.col("mid") - F.col("down") * _scatter()).withColumn("high", F.col("mid") + F.col("up") * _scatter())
    return wide.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(True)))


def _scatter() -> Column:
    return F.sqrt(1 + F.lit(float(SCATTER)) / F.greatest("n_bytes", F.lit(1)))


def _median(values: DataFrame) -> DataFrame:
    """(lang, x): the median step of (lang, step, n); counts of steps are summed before any window sees them."""
    from pyspark.sql import Window as W

    by = W.partitionBy("lang").orderBy("step")
    run = values.withColumn("upto", F.sum("n").over(by)).withColumn("all", F.sum("n").over(W.partitionBy("lang")))
    return run.where(2 * F.col("upto") >= F.col("all")).groupBy("lang").agg(F.min("step").alias("x"))


def bands(scored: DataFrame, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """(lang, mid, down, up): the median log perplexity and the widths of both sides, from counts of rounded values of all rows."""
    middle = _median(scored.select("lang", F.round(F.col("log_perplexity") * STEP).cast("long").alias("step")).groupBy("lang", "step").agg(F.count("*").alias("n"))).withColumnRenamed("x", "mid")
    off = scored.join(middle, "lang").select("lang", F.round((F.col("log_perplexity") * STEP - F.col("mid")) / _scatter()).cast("long").alias("step")).groupBy("lang", "step").agg(F.count("*").alias("n"))
    below = _median(off.where("step <= 0").withColumn("step", -F.col("step"))).withColumnRenamed("x", "below")
    above = _median(off.where("step >= 0")).withColumnRenamed("x", "above")

    def width(side: str, times: float) -> Column:
        return F.when(F.col(side) > 0, F.lit(times) * F.col(side) / STEP).otherwise(F.lit(MIN_WIDTH))

    both = middle.join(below, "lang", "left").join(above, "lang", "left")
    return both.select("lang", (F.col("mid") / STEP).alias("mid"), width("below", lower).alias("down"), width("above", upper).alias("up"))


def op8(spark, sf_dir: str) -> DataFrame:
    got = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "log_perplexity", "low", "high")
