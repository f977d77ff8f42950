"""Operator 3: benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+. A window is ``span``
consecutive words of a benchmark item; an item of fewer words (but not none) is one window. Winnowing keeps
the minimum k-gram hash of every run of ``span - k + 1`` k-grams, so any shared window shares a fingerprint.
Document fingerprints meet the benchmark's by hash, the hits are extended to all windows around them, and a
join on the windows' words (not on hashes) keeps the true ones. A short item of n words gets its own (k, run)
with the same guarantee.

The benchmark's distinct fingerprints are matched inside the scan while there are at most
``BROADCAST_HASHES`` of them (16 MB); beyond that the fingerprints of the documents are joined with a shuffle.

Defined cases: a null or empty text has no words, is never hit and never contaminated; rows that repeat a
doc_id are judged each by its own text; a null item_id hits words but is not listed; an empty benchmark hits
nothing; other columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm import textarrays as ta

SPAN = 13
#: A document is contaminated from one hit word in SHARE on.
SHARE = 20
BROADCAST_HASHES = 2_000_000
#: So many keys (16 bytes) of contaminated documents at most are broadcast to take them out.
BROADCAST_BAD = 200_000


def gram(span: int) -> int:
    """Words of a k-gram for windows of ``span`` words; the rest of the span is the winnowing run."""
    return max(1, (span * 2) // 5)


def winnow(grams: np.ndarray, run: int) -> np.ndarray:
    """Positions of the minima of all runs; equal minima are all kept, so the choice depends on content only."""
    if len(grams) < run:
        return np.zeros(0, np.int64)
    low = ta.sliding(grams, run, np.minimum)
    pad = np.zeros(run - 1, ta.U64)
    high = ta.sliding(np.concatenate([pad, low, pad]), run, np.maximum)
    return np.flatnonzero(grams == high)


def fingerprints(word_hash: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of one text's winnowed k-grams for windows of ``span`` words."""
    k = gram(span)
    grams = ta.gram_hash(word_hash, k)
    at = winnow(grams, span - k + 1)
    return at, grams[at]


def _item_windows(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, text = batch.column(0).to_pylist(), "text"
            out: dict[str, list] = {"item": [], "n": [], "key": [], "hash": []}
            for lo, hi, data, offs in ta.pieces(batch, text):
                data = ta.LOWER[data]
                starts, ends, rows = ta.words(data, offs, ta.ALNUM)
                if not len(starts):
                    continue
                wh = ta.span_hash(data, starts, ends)
                for r in range(lo, hi):
                    a, b = rows[r - lo], rows[r - lo + 1]
                    if a == b:
                        continue
                    n = min(span, b - a)
                    ws = [data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(starts[a:b], ends[a:b], strict=True)]
                    keys = {" ".join(ws[i : i + n]) for i in range(b - a - n + 1)}
                    _, h = fingerprints(wh[a:b], n)
                    h = list(dict.fromkeys(h.view(np.int64).tolist()))
                    for col, x in (("item", [item[r]] * (len(keys) + len(h))), ("n", [int(n)] * (len(keys) + len(h))), ("key", [*keys, *[None] * len(h)]), ("hash", [*[None] * len(keys), *h])):
                        out[col] += x
            yield pa.RecordBatch.from_arrays([pa.array(out["item"], pa.string()), pa.array(out["n"], pa.int32()), pa.array(out["key"], pa.string()), pa.array(out["hash"], pa.int64())], names=[*out])

    return run


def _near(at: np.ndarray, n: int, words: int) -> np.ndarray:
    """Starts of all windows of n words that hold a k-gram at one of the positions ``at``."""
    back = n - gram(n)
    starts = np.unique((at[:, None] - np.arange(back + 1)[None, :]).ravel())
    return starts[(starts >= 0) & (starts <= words - n)]


def _doc_windows(spans: list[int], hashes):
    """Rows (doc_id, text_hash, n_words, start, n, key): the windows to verify; each input row also gives one with start -1.

    ``hashes``: broadcast {n: sorted hashes} to match in the scan, or None where the input has a column
    ``hits`` of (n, pos) that a join has found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, th = batch.column(0), batch.column(2)
            hits = batch.column(3).to_pylist() if hashes is None else None
            for lo, hi, data, offs in ta.pieces(batch, "text"):
                data = ta.LOWER[data]
                starts, ends, rows = ta.words(data, offs, ta.ALNUM)
                counts = np.diff(rows)
                wh = ta.span_hash(data, starts, ends) if len(starts) else np.zeros(0, ta.U64)
                row, first, size, key = [np.arange(lo, hi)], [np.full(hi - lo, -1)], [np.zeros(hi - lo, np.int64)], [None] * (hi - lo)
                for n in spans:
                    by_row: dict[int, np.ndarray] = {}
                    if hashes is not None:
                        at, h = fingerprints(wh, n)
                        for r, p in _per_text(wh, rows, n, at, h, hashes.value[n]):
                            by_row[r] = p
                    else:
                        for r in range(hi - lo):
                            p = [x["pos"] for x in hits[lo + r] or () if x["n"] == n]
                            if p:
                                by_row[r] = np.array(p, np.int64)
                    for r, p in by_row.items():
                        s = _near(p, n, int(counts[r]))
                        base = rows[r]
                        row.append(np.full(len(s), lo + r))
                        first.append(s)
                        size.append(np.full(len(s), n))
                        for i in (s + base).tolist():
                            key.append(" ".join(data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts[i : i + n].tolist(), ends[i : i + n].tolist())))
                row = np.concatenate(row)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row)), th.take(pa.array(row)), pa.array(counts[row - lo].astype(np.int64)), pa.array(np.concatenate(first).astype(np.int32)), pa.array(np.concatenate(size).astype(np.int32)), pa.array(key, pa.string())],
                    names=["doc_id", "text_hash", "n_words", "start", "n", "key"],
                )

    return run


def _per_text(wh, rows, n, at, h, known):
    """(row, positions) of fingerprints of each text that the benchmark has.

    Winnowing a whole piece keeps, inside each text, every minimum of the runs that lie in it: a run never
    looks beyond its own n words. Minima of runs across two texts only add candidates.
    """
    if not len(at) or not len(known):
        return
    i = np.searchsorted(known, h)
    found = at[known[np.minimum(i, len(known) - 1)] == h]
    r = np.searchsorted(rows, found, "right") - 1
    for x in np.unique(r).tolist():
        yield x, found[r == x] - rows[x]


def _fingerprint_rows(spans: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, _hi, data, offs in ta.pieces(batch, "text"):
                data = ta.LOWER[data]
                starts, ends, rows = ta.words(data, offs, ta.ALNUM)
                if not len(starts):
                    continue
                wh = ta.span_hash(data, starts, ends)
                for n in spans:
                    at, h = fingerprints(wh, n)
                    r = np.searchsorted(rows, at, "right") - 1
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(lo + r)), pa.array(np.full(len(at), n, np.int32)), pa.array((at - rows[r]).astype(np.int32)), pa.array(h.view(np.int64))], names=["doc_id", "n", "pos", "hash"])

    return run


def match(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, spans (merged word ranges [start, end)), items (sorted strings)."""
    from plumbline.sources.shared import stored

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(_item_windows(span), "item string, n int, key string, hash long")
    items = stored(items, "windows")
    prints = items.where("hash IS NOT NULL").select("n", "hash").distinct()
    spans = sorted(r.n for r in items.select("n").distinct().collect())
    doc_type = dict(docs.dtypes)["doc_id"]
    out = f"doc_id {doc_type}, text_hash long, n_words long, start int, n int, key string"
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    if prints.count() <= BROADCAST_HASHES:
        told = prints.toArrow()
        size, found = told["n"].to_numpy(), told["hash"].to_numpy().view(np.uint64)
        known = docs.sparkSession.sparkContext.broadcast({n: np.sort(found[size == n]) for n in spans})
        windows = base.mapInArrow(ta.task(_doc_windows(spans, known)), out)
    else:
        found = docs.select("doc_id", "text").mapInArrow(_fingerprint_rows(spans), f"doc_id {doc_type}, n int, pos int, hash long")
        found = found.join(prints, ["n", "hash"], "left_semi").groupBy("doc_id").agg(F.collect_set(F.struct("n", "pos")).alias("hits"))
        found = found.withColumnRenamed("doc_id", "_id")
        windows = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "text_hash", "hits").mapInArrow(_doc_windows(spans, None), out)
    keys = items.where("key IS NOT NULL").select("key", "item").distinct()
    # each document's own row has no key, so it stays out of the join; stored, so that the texts are read once
    windows = stored(windows, "spans")
    hit = windows.where("start >= 0").join(keys, "key").unionByName(windows.where("start = -1").withColumn("item", F.lit(None).cast("string")))
    per = hit.groupBy("doc_id", "text_hash").agg(
        F.sum(F.when(F.col("start") == -1, 1).otherwise(0)).alias("rows"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("start") >= 0, F.struct("start", (F.col("start") + F.col("n")).alias("end"))))).alias("hits"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    merged = F.expr(
        """aggregate(hits, cast(array() as array<struct<start:int,end:int>>), (acc, x) ->
           if(size(acc) > 0 and element_at(acc, -1).end >= x.start,
              concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).start as start, greatest(element_at(acc, -1).end, x.end) as end))),
              concat(acc, array(struct(x.start as start, x.end as end)))))"""
    )
    per = per.withColumn("spans", merged)
    per = per.withColumn("n_hit", F.expr("cast(aggregate(spans, 0, (a, x) -> a + x.end - x.start) as long)"))
    return per.select(F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_"), "doc_id", "text_hash", "n_words", "n_hit", "spans", "items").drop("_")


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (F.lit(SHARE) * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated."""
    from plumbline.sources.shared import stored

    bad = match(docs, benchmark, span).where(contaminated()).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("th")).distinct()
    bad = stored(bad, "contaminated")
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_BAD else bad
    # docs travels as one struct, so its columns can have any names
    keyed = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("hash"), F.struct(*docs.columns).alias("row"))
    left = keyed.join(bad, F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("th")), "left_anti")
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op3(spark, sf_dir: str) -> DataFrame:
    got = match(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return got.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP3_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), {SPAN}) AS n, array_to_string(w[i:i + least(len(w), {SPAN}) - 1], ' ') AS key
       FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), {SPAN}) + 2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS key
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw USING (key, n)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY 1),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
