"""Operator 7: SimHash near-duplicates by the generalised pigeonhole principle.

Each text gets a 64-bit fingerprint of its word shingles. The distinct fingerprints are compared: correlated
bits are grouped into m partitions, and partition i gets a threshold t_i with sum(t_i) = limit - m + 1, so two
fingerprints within ``limit`` bits differ by at most t_i bits in some partition i. Partitions and thresholds
come from statistics of all fingerprints: the pairs with equal values of each partition are counted from its histogram of
values, those within more bits are scaled from it, and a dynamic programme takes the thresholds that cost the fewest
probes and candidates. One side enumerates the values within t_i, the other is looked up by its own value, and
``bit_count`` of the XOR verifies each candidate.

Linked fingerprints form components. Nearest links come first (neighbours in sorted order, joined within each batch), and
pairs that are in one component already are not listed again, so a large group of near copies gives few links. Where many fingerprints
share a value, those of the value's largest group are not compared with each other at all. Components come from
large-star and small-star joins on stored tables.

Defined cases: a null or empty text has no words and fingerprint zero, linked like any other; repeated rows and
repeated doc_ids get one output row each; a null doc_id never becomes a component's id unless all are null; an
empty table gives no rows; other columns are not returned.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm import textarrays as ta
from plumbline.sources.shared import drop_stored, stored

SHINGLE = 4
LIMIT = 4
SEED = 42
#: Shingles whose bits are laid out at once.
PIECE = 1 << 14
#: A probe is a row that is shuffled and sorted, a candidate is one comparison of two longs; this many weigh as much.
PROBE_COST = 10


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one UTF-8 text, as a signed 64-bit integer."""
    import xxhash

    # bytes.lower and bytes.split know A-Z and the white space 0x20, 0x09-0x0D only
    ws = raw.lower().split()
    if not ws:
        return 0
    text = b" ".join(ws)
    if len(ws) <= shingle:
        h = [xxhash.xxh64_intdigest(text, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        h = [digest(text[a:b], SEED) for a, b in zip(starts[: len(ws) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]
    hashes, counts = np.array(h, np.uint64).view(np.uint8).reshape(-1, 8), np.zeros(64, np.int64)
    for lo in range(0, len(h), PIECE):
        counts += np.unpackbits(hashes[lo : lo + PIECE], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    most = 2 * counts > len(h)
    return int(np.packbits(most, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp long) of every row; th is a hash of the text that tells rows of one doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py().encode() if t.is_valid else b"", shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["doc_id", "th", "fp"])

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(ta.task(run), f"doc_id {dict(docs.dtypes)['doc_id']}, th long, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """(number of rows, 64 x 64 counts of rows with both bits set), summed over all rows in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64), np.int64), 0
        for batch in batches:
            x = batch.column(0).to_numpy().astype(np.int64)
            bits = np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(np.append(total.ravel(), n))], names=["cell", "n"])

    rows = fps.select("fp").mapInArrow(ta.task(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(4097, np.int64)
    for r in rows:
        flat[r.cell] = r.n
    return int(flat[4096]), flat[:4096].reshape(64, 64)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m groups of bits, sizes within one of each other; each grows by the bit that correlates most with it."""
    p = both.diagonal() / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(64)), []
    for i in range(m):
        size = 64 // m + (i < 64 % m)
        order = sorted(left)
        group = [max(order, key=lambda b: (corr[b, order].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def equal_pairs(fps: DataFrame, groups: list[list[int]]) -> list[int]:
    """Pairs of rows with equal values of each group of bits, from the histogram of the values of all rows."""
    values = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_signed(g))).alias("v")) for i, g in enumerate(groups)])
    counts = fps.select(F.explode(values).alias("x")).groupBy("x.i", "x.v").agg(F.count("*").alias("n"))
    got = {r.i: r.pairs for r in counts.groupBy("i").agg(F.sum(F.expr("n * (n - 1) div 2")).alias("pairs")).collect()}
    return [int(got.get(i) or 0) for i in range(len(groups))]


def estimated_pairs(n: int, both: np.ndarray, group: list[int], limit: int, equal: int) -> list[float]:
    """Pairs expected to differ by at most t bits in the group, for t = 0..limit.

    ``equal`` is the count for t = 0; larger t are in the proportion that the bits' frequencies give.
    """
    p = both.diagonal()[group] / max(n, 1)
    differ = 2 * p * (1 - p)
    dist = np.zeros(limit + 2)
    dist[0] = 1
    for d in differ:
        dist[1:] = dist[1:] * (1 - d) + dist[:-1] * d
        dist[0] *= 1 - d
    most = n * (n - 1) / 2
    chance = np.cumsum(dist[: limit + 1])
    return np.minimum(equal + (chance - chance[0]) * most * max(1.0, equal / max(chance[0] * most, 1.0)), most).tolist()


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 of sum ``total`` with the least summed cost; costs[i][t + 1], t = -1 skips a partition."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, len(cost) - 1):
                cand = (c + cost[t + 1], [*ts, t])
                if used + t not in step or cand < step[used + t]:
                    step[used + t] = cand
        best = step
    return best[total]


def plan(fps: DataFrame, limit: int = LIMIT, most: int = 6) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition, for the number of partitions that costs least."""
    n, both = bit_statistics(fps)
    ways = [group_bits(n, both, m) for m in range(2, min(most, limit + 1) + 1)]
    equal = iter(equal_pairs(fps, [g for groups in ways for g in groups]))
    found = None
    for groups in ways:
        costs = []
        for g in groups:
            pairs = estimated_pairs(n, both, g, limit, next(equal))
            probes = list(itertools.accumulate(n * comb(len(g), t) for t in range(limit + 1)))
            costs.append([0.0, *[PROBE_COST * (n + b) + a for a, b in zip(pairs, probes)]])
        cost, ts = allocate(costs, limit - len(groups) + 1)
        if found is None or cost < found[0]:
            found = (cost, [(g, t) for g, t in zip(groups, ts) if t >= 0])
    return found[1]


def _signed(bits) -> int:
    x = sum(1 << b for b in bits)
    return x - (1 << 64) if x >> 63 else x


def _flips(bits: list[int], t: int) -> list[int]:
    return [_signed(c) for k in range(t + 1) for c in itertools.combinations(bits, k)]


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root), root < node: for the links a - b, each node with the smallest node it reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while (root[one] != root[two]).any():
        # every root with a smaller one beside it goes below that, which leaves half of them at most
        np.minimum.at(root, np.maximum(root[one], root[two]), np.minimum(root[one], root[two]))
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _near(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = np.zeros(0, np.int64), np.zeros((2, 0), np.int64)
        for batch in batches:
            x = np.concatenate([last, batch.column(0).to_numpy().astype(np.int64)])
            a, b = [kept[0]], [kept[1]]
            for k in (1, 2, 3):
                u, v = x[:-k], x[k:]
                near = np.bitwise_count((u ^ v).view(np.uint64)) <= limit
                a.append(u[near])
                b.append(v[near])
            node, root = stars(np.concatenate(a), np.concatenate(b))
            yield pa.RecordBatch.from_arrays([pa.array(root), pa.array(node)], names=["a", "b"])
            last = x[-3:]
            # the next batch goes on from the roots of this one
            at = np.isin(node, last)
            kept = np.array([node[at], root[at]])

    return run


def near_links(fps: DataFrame, parts: list[tuple[list[int], int]], limit: int) -> DataFrame:
    """Links (a, b), a < b, that join neighbours when the fingerprints are sorted by each partition in turn.

    A few links that join most of a dense group: a task's batches replace the links of neighbours by links to the smallest
    fingerprint that they reach. Sorting is by range, one for all partitions, so no group meets in one task; the last
    fingerprint of a task isn't compared with the first of the next, which the full search makes up for.
    """
    values = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(bits))).alias("value")) for i, (bits, _) in enumerate(parts)])
    ordered = fps.select("fp", F.explode(values).alias("x")).select("x.part", "x.value", "fp").repartitionByRange("part", "value", "fp").sortWithinPartitions("part", "value", "fp")
    return ordered.select("fp").mapInArrow(ta.task(_near(limit)), "a long, b long")


def search_links(fps: DataFrame, parts: list[tuple[list[int], int]], limit: int) -> DataFrame:
    """Links (a, b), a < b, between all pairs of fingerprints within ``limit`` bits that aren't in one group yet.

    ``fps`` has fp and grp. A probe is the value of a partition with up to its threshold of bits flipped. A probe of a
    value's largest group meets the other groups' fingerprints only, so k near copies never make k * k candidates.
    """
    probes, own = [], []
    for i, (bits, t) in enumerate(parts):
        value = F.col("fp").bitwiseAND(F.lit(_signed(bits)))
        flips = F.lit(_flips(bits, t)).cast("array<long>")
        own.append(F.struct(F.lit(i).alias("part"), value.alias("value")))
        probes.append(F.transform(flips, lambda flip: F.struct(F.lit(i).alias("part"), value.bitwiseXOR(flip).alias("value"))))
    left = fps.select(F.explode(F.concat(*probes)).alias("x"), "fp", "grp").select("x.part", "x.value", F.col("fp").alias("a"), F.col("grp").alias("ga"))
    right = fps.select(F.explode(F.array(*own)).alias("x"), "fp", "grp").select("x.part", "x.value", F.col("fp").alias("b"), F.col("grp").alias("gb"))
    sizes = right.groupBy("part", "value", "gb").agg(F.count("*").alias("n")).groupBy("part", "value").agg(F.max(F.struct("n", "gb")).alias("m"))
    sizes = sizes.select("part", "value", F.col("m.gb").alias("largest"))
    own, left = right.join(sizes, ["part", "value"]), left.join(sizes, ["part", "value"])
    close = (F.col("a") < F.col("b")) & (F.col("ga") != F.col("gb")) & (distance(F.col("a"), F.col("b")) <= limit)
    out = None
    for some, others in ((left, own.where("gb <> largest")), (left.where("ga <> largest"), own.where("gb = largest"))):
        found = some.drop("largest").join(others.drop("largest"), ["part", "value"]).where(close).select("a", "b")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def settled(edges: DataFrame) -> bool:
    """Whether every node of the distinct links (u, v), v < u, has one smaller one, which has none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    per = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return per.where("below > 1 OR (below = 1 AND above = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root): each linked node with the smallest node it reaches; large-star and small-star until all links are stars.

    Every step is joins and map-side combined minima over stored tables; a node with very many links is split by
    Spark's skew join.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        after = stored(small.where("u <> v").distinct(), "links")
        drop_stored(edges)
        edges = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def grouped(prints: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint; ``prints`` is a stored :func:`fingerprints`.

    component_id is the smallest doc_id of the component.
    """
    fps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    parts = plan(fps, limit)
    near = components(near_links(fps, parts, limit))
    known = stored(fps.join(near, fps.fp == near.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("grp")), "prints")
    drop_stored(near)
    # links between groups, told by the groups' roots
    found = stored(search_links(known.select("fp", "grp"), parts, limit), "found")
    of = known.select(F.col("fp").alias("x"), F.col("grp").alias("g"))
    by_a = found.join(of, found.a == of.x).select(F.col("g").alias("ga"), "b")
    cross = by_a.join(of, by_a.b == of.x).select(F.col("ga").alias("a"), F.col("g").alias("b"))
    roots = components(cross)
    drop_stored(fps)
    drop_stored(found)
    final = known.join(roots, known.grp == roots.node, "left").select("fp", "least", F.coalesce("root", "grp").alias("comp"))
    ids = final.groupBy("comp").agg(F.min("least").alias("component_id"))
    done = stored(final.join(ids, "comp").select("fp", "component_id"), "groups")
    drop_stored(known)
    drop_stored(roots)
    return done


def near_duplicates(docs: DataFrame, limit: int = LIMIT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, th, fp, component_id of every row."""
    prints = stored(fingerprints(docs, shingle), "fp")
    return prints.join(grouped(prints, limit), "fp").select("doc_id", "th", "fp", "component_id")


def keep_one(docs: DataFrame, limit: int = LIMIT, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the document with the smallest doc_id.

    Only keys of 16 bytes take part in the choice; the texts are shuffled once, by key. ``docs`` travels as one struct,
    so its columns can have any names.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = stored(near_duplicates(docs, limit, shingle), "near")
    best = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("b")).select("b.*").select("none", key.alias("id"), "th")
    keyed = docs.select(F.col("doc_id").isNull().alias("none"), key.alias("id"), F.xxhash64("text").alias("th"), F.struct(*docs.columns).alias("row"))
    # the same keys, none of them null, so that the join and the choice of one row read one shuffle of the texts
    return keyed.join(best, ["none", "id", "th"], "left_semi").dropDuplicates(["none", "id", "th"]).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op7(spark, sf_dir: str) -> DataFrame:
    got = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
