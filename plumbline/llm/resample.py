"""Operator 12: importance resampling toward a target distribution, with texts cut into lines and each line counted once.

Features are runs of 1 to 3 words, hashed into buckets. A text is its lines (cut at newlines) and the features that cross
them:

1. Tasks cut texts into lines; equal lines of a task leave it as one row with the number of times they stand there, and
   one aggregation by line gives the distinct lines of the corpus with their occurrences.
2. The features of each distinct line are hashed once and stored as sorted bucket numbers. Features that cross a newline
   need at most two words of either side; they stay with their document.
3. Bucket counts are the lines' features times their occurrences and the crossing features, summed. Two such tables, of
   the corpus and of the target, give the gain of each bucket (a list of ``BUCKETS`` numbers, whatever the input).
4. A line's weight is the sum of its gains; documents meet the weights of their lines in a join, a row per document and
   distinct line, and add the weights of their crossing features.
5. Scores add Gumbel noise from a hash of the key, so the highest are a weighted draw without replacement. Ranks come from
   a sort by ranges: a row's place in its range plus the sizes of the ranges before it.

Lines are equal by their words in the aggregation, and meet their documents by 128 bits of XXH3 of these words.

Defined cases: null and empty texts, and texts without words, have no feature and weight 0; they are never drawn, nor are
texts of fewer than ``least`` words; rows that repeat a key or a text are scored and drawn each, further ties in no order;
a null key is hashed as the empty string and sorts first among ties; an empty target or corpus counts nothing, and gains
come from the added ones; only the key and the figures are returned, so no column can clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.sources.shared import drop_stored, stored

BUCKETS = 10_000
#: Texts of fewer words are never drawn; so many in a hundred of the others are.
LEAST, PERCENT = 20, 5
SEED = "42"
#: Text of distinct lines that a task holds back.
HELD_BYTES = 16 << 20
#: Bytes to words' bytes: A-Z become a-z, other ASCII but digits and letters a blank.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def lines_of(text: str | None) -> list[bytes]:
    """The lines of a text that have a word: their words, lower-cased, with single blanks."""
    cut = (text or "").encode("utf-8", "replace").translate(_WORDS[:10] + b"\n" + _WORDS[11:]).split(b"\n")
    return [x for line in cut if (x := b" ".join(line.split()))]


def line_buckets(line: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of all runs of 1 to 3 words of a line, repeats included."""
    words = line.split()
    more = [b" " + w for w in words[1:]]
    one = list(map(crc32, words))
    two = list(map(crc32, more, one))
    three = list(map(crc32, more[1:], two))
    return np.array(one + two + three, np.int64) % buckets


def crossing_buckets(lines: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of all runs of 2 and 3 words that no single line holds."""
    out, two, one = [], b"", b""  # the last word but one and the last word so far
    for line in lines:
        head = line.split(b" ", 2)[:2]
        if one:
            out.append(one + b" " + head[0])
            if two:
                out.append(two + b" " + one + b" " + head[0])
            if len(head) == 2:
                out.append(one + b" " + head[0] + b" " + head[1])
        tail = line.rsplit(b" ", 2)[-2:]
        two, one = (tail[0], tail[1]) if len(tail) == 2 else (one, tail[0])
    return np.array(list(map(crc32, out)), np.int64) % buckets


def _body(buckets: np.ndarray) -> bytes:
    """Sorted bucket numbers as differences, in planes of bytes: they compress well."""
    x = np.diff(np.sort(buckets), prepend=0).astype("<u4")
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_body(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64))


def _key(line: bytes) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(line)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, n): the lines of a task; equal ones leave together, as long as they are held."""
    held, size = {}, 0

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(held.values(), pa.int64())], names=["line", "n"])

    for batch in batches:
        for text in batch.column(0):
            for line in lines_of(text.as_py()):
                if line in held:
                    held[line] += 1
                else:
                    held[line], size = 1, size + len(line) + 100
            if size > HELD_BYTES:
                yield closed()
                held, size = {}, 0
    if held:
        yield closed()


def _features(buckets: int):
    """(key, n, words, body) of each distinct line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column(0).to_pylist()
            for lo in range(0, len(lines), 2000):
                own = lines[lo : lo + 2000]
                made = [list(map(_key, own)), batch.column(1).slice(lo, len(own)), [x.count(b" ") + 1 for x in own], [_body(line_buckets(x, buckets)) for x in own]]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) if isinstance(x, list) else x for x, k in zip(made, (pa.binary(), None, pa.int64(), pa.binary()))], names=["key", "n", "words", "body"])

    return run


def _parts(buckets: int):
    """(id, lines, body) of each document: its distinct lines with their occurrences, and its crossing features."""
    kind = pa.list_(pa.struct([("key", pa.binary()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                own = batch.slice(lo, 500)
                lines, bodies = [], []
                for text in own.column(1):
                    found, count = lines_of(text.as_py()), {}
                    for x in found:
                        count[x] = count.get(x, 0) + 1
                    lines.append([{"key": _key(x), "n": n} for x, n in count.items()])
                    bodies.append(_body(crossing_buckets(found, buckets)))
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(lines, kind), pa.array(bodies, pa.binary())], names=["id", "lines", "body"])

    return run


def _sums(buckets: int):
    """(bucket, n): the bucket counts of a task's rows (n, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for n, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                np.add.at(total, _from_body(body.as_py()), n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def _weighed(gain):
    """(the columns before the body, weight): the sum of gains of each body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = gain.value
        for batch in batches:
            *kept, bodies = batch.columns
            weight = [int(gains[_from_body(x.as_py())].sum()) for x in bodies]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(weight, pa.int64())], names=[*batch.schema.names[:-1], "weight"])

    return run


class Counted:
    """A table's distinct lines and documents' parts, stored, and its bucket counts."""

    def __init__(self, docs: DataFrame, key: str, text: str, buckets: int):
        lines = docs.select(text).mapInArrow(_lines, "line binary, n long").groupBy("line").agg(F.sum("n").alias("n"))
        self.lines = stored(lines.mapInArrow(_features(buckets), "key binary, n long, words long, body binary"), "lines")
        kind = docs.select(F.col(f"`{key}`")).schema.fields[0].dataType.simpleString()
        parts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`")).mapInArrow(_parts(buckets), f"id {kind}, lines array<struct<key: binary, n: long>>, body binary")
        self.parts = stored(parts.withColumn("row", F.monotonically_increasing_id()), "parts")
        both = self.lines.select("n", "body").mapInArrow(_sums(buckets), "bucket long, n long").union(self.parts.select(F.lit(1).cast("long"), "body").mapInArrow(_sums(buckets), "bucket long, n long"))
        self.counts = np.zeros(buckets, np.int64)
        for r in both.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():  # a row a bucket, whatever the input
            self.counts[r.bucket] = r.n

    def drop(self) -> None:
        drop_stored(self.lines)
        drop_stored(self.parts)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares) of each bucket."""
    s_all, t_all, more = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + more) / ((s + 1) * (t_all + more)))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _noise(key: Column, seed: str) -> Column:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def score(docs: DataFrame, target: DataFrame, key: str = "doc_id", target_key: str = "item_id", text: str = "text", seed: str = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(key, n_words, n_features, weight, score) of each row of ``docs``."""
    wanted = Counted(target, target_key, text, buckets)
    own = Counted(docs, key, text, buckets)
    wanted.drop()
    told = docs.sparkSession.sparkContext.broadcast(gains(own.counts, wanted.counts))
    weights = own.lines.select("key", "words", "body").mapInArrow(_weighed(told), "key binary, words long, weight long")
    of_lines = own.parts.select("row", F.explode("lines").alias("line")).select("row", "line.key", "line.n").join(weights, "key").select("row", F.lit(None).alias("id"), (F.col("n") * F.col("words")).alias("words"), (F.col("n") * F.col("weight")).alias("weight"))
    kind = own.parts.schema["id"].dataType
    crossing = own.parts.select("row", "id", "body").mapInArrow(_weighed(told), f"row long, id {kind.simpleString()}, weight long").select("row", "id", F.lit(0).alias("words"), "weight")
    found = of_lines.withColumn("id", F.col("id").cast(kind)).unionByName(crossing).groupBy("row").agg(F.max("id").alias("id"), F.sum("words").alias("words"), F.sum("weight").alias("weight"))
    features = F.col("words") + F.greatest(F.col("words") - 1, F.lit(0)) + F.greatest(F.col("words") - 2, F.lit(0))
    made = found.select("row", "id", F.col("words").alias("n_words"), features.alias("n_features"), "weight", (F.col("weight") + _noise(F.col("id"), seed)).alias("score"))
    out = stored(made, "scores")
    own.drop()
    return out


def ranked(scores: DataFrame, least: int = LEAST, percent: int = PERCENT) -> DataFrame:
    """``scores`` (row, id, n_words, score and others) with the column rank: 1, 2, 3 ... of the rows drawn, else null."""
    of = scores.where(F.col("n_words") >= least)
    many = of.count()
    order = [F.col("score").desc(), F.col("id").asc(), F.col("row").asc()]
    # a global sort deals rows by ranges; this id is the range and, in its lower 33 bits, the place in it
    dealt = stored(of.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "ranges").withColumn("range", F.shiftright("place", 33))
    sizes = dealt.groupBy("range").agg(F.count("*").alias("size"))  # a row a range, as many as the sort has tasks
    before = sizes.select("range", F.coalesce(F.sum("size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    drawn = dealt.join(F.broadcast(before), "range").withColumn("rank", F.when(rank <= percent * many // 100, rank).cast("long"))
    rest = scores.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    return drawn.drop("place", "range", "before").unionByName(rest)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return ranked(score(docs, target)).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
