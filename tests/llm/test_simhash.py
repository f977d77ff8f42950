import random

import numpy as np
import pyarrow as pa
import xxhash

from plumbline.llm import simhash


def brute_print(text):
    import re

    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
    if not w:
        return 0
    s = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, limit=4):
    fps = [brute_print(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= limit:
                comp[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/t7"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return sorted(map(tuple, simhash.op7(spark, path).collect()), key=str)


def test_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "ONE  two"), (1003, "again and again"), (None, "one two"), (1005, "x " * 3000), (None, "é É \x1c \x85")]
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(400)] = f"v{rng.randrange(10**6)}"
        rows.append((2000 + i, " ".join(w)))
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_search_finds_all_pairs(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for x in list(fps)[:150]:
        y = x
        for b in rng.sample(range(64), rng.randrange(1, 6)):
            y ^= 1 << b
        fps.add(y)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    df = spark.createDataFrame([(x, x) for x in signed], "fp long, grp long")
    n, both = simhash.bit_statistics(df)
    for m in (2, 3, 4, 5):
        groups = simhash.group_bits(n, both, m)
        assert sorted(sum(groups, [])) == [*range(64)]
        costs = [[0.0, *[x * (1 + i) for x in (1, 5, 50, 500, 5000)]] for i in range(m)]
        ts = simhash.allocate(costs, 4 - m + 1)[1]
        assert sum(ts) == 4 - m + 1
        parts = [(g, t) for g, t in zip(groups, ts) if t >= 0]
        if max(t for _, t in parts) < 3:
            assert {(r.a, r.b) for r in simhash.search_links(df, parts, 4).collect()} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 107), (107, 103), (200, 201), (5, 5)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(i, i) == 0 for i in range(41)) and got[107] == got[103] == 100 and got[201] == 200


def test_pairs_of_one_group_are_left_out(spark):
    """Two large groups that share values: only links between them are listed, and the larger group never meets itself."""
    rng = random.Random(8)
    base = rng.getrandbits(63)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(60), rng.randrange(0, 4))) for _ in range(250)})
    group = {x: rng.randrange(4) if rng.random() < 0.4 else 0 for x in fps}
    want = {(a, b) for a in fps for b in fps if a < b and group[a] != group[b] and (a ^ b).bit_count() <= 4}
    df = spark.createDataFrame([(x, group[x]) for x in fps], "fp long, grp long")
    parts = simhash.plan(df)
    assert {(r.a, r.b) for r in simhash.search_links(df, parts, 4).collect()} == want


def test_plan_counts_candidates_from_the_histogram(spark):
    """Equal pairs are exact; estimates for more bits are within a factor of the true ones on real fingerprints."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fps = simhash.fingerprints(docs).select("fp").distinct()
    xs = [r.fp & (1 << 64) - 1 for r in fps.collect()]
    n, both = simhash.bit_statistics(fps)
    groups = simhash.group_bits(n, both, 5)
    equal = simhash.equal_pairs(fps, groups)
    for g, e in zip(groups, equal):
        mask = sum(1 << b for b in g)
        near = [0] * 65
        for i in range(len(xs)):
            for j in range(i):
                near[((xs[i] ^ xs[j]) & mask).bit_count()] += 1
        told = simhash.estimated_pairs(n, both, g, 4, e)
        assert e == near[0] and told[0] == e
        assert all(sum(near[: t + 1]) / 8 <= told[t] <= 8 * sum(near[: t + 1]) for t in (1, 2))
    parts = simhash.plan(fps)
    m = len(simhash.group_bits(n, both, len(parts)))
    assert sum(t for _, t in parts) - (m - len(parts)) == 4 - m + 1 and sorted(b for g, _ in parts for b in g) == [*range(64)]


def test_plan_takes_unequal_thresholds_where_bits_say_little(spark):
    """Twelve bits that never vary fall into one group, which the plan passes over: another group bears a flip for it."""
    rng = random.Random(6)
    fps = [rng.getrandbits(52) for _ in range(1800)]
    for x in fps[:200]:
        y = x
        for b in rng.sample(range(52), rng.randrange(1, 6)):
            y ^= 1 << b
        fps.append(y)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(x, x) for x in fps], "fp long, grp long")
    parts = simhash.plan(df)
    assert sorted(t for _, t in parts) == [0, 0, 0, 1] and sum(len(g) for g, _ in parts) == 52
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 4}
    assert {(r.a, r.b) for r in simhash.search_links(df, parts, 4).collect()} == want and len(want) > 100


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x", 1, 5), (2, "a b c d e f", "y", 2, 6), (None, "p q r s t u v w", "z", 3, 7), (4, None, "q", 4, None)], "doc_id long, text string, _id string, th long, id long")
    got = sorted(map(tuple, simhash.keep_one(docs).collect()), key=str)
    assert got == [(1, "a b c d e f", "x", 1, 5), (4, None, "q", 4, None), (None, "p q r s t u v w", "z", 3, 7)]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_stars_reach_the_smallest_node():
    rng = random.Random(4)
    for n, m in ((1, 0), (2, 1), (50, 30), (300, 290), (300, 900)):
        nodes = [rng.getrandbits(63) - (1 << 62) for _ in range(n)]
        pairs = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(m)] + [*zip(nodes[:9], nodes[1:10])]
        low = {x: x for x in nodes}
        for _ in nodes:
            for a, b in pairs:
                low[a] = low[b] = min(low[a], low[b])
        a, b = np.array(pairs, np.int64).reshape(-1, 2).T
        node, root = simhash.stars(a, b)
        assert dict(zip(node.tolist(), root.tolist())) == {x: r for x, r in low.items() if r != x}


def test_neighbours_in_several_batches_have_one_root():
    """A chain of fingerprints, each one bit from the next, that comes in seven batches."""
    chain = [(1 << k) - 1 for k in range(63)]
    got = pa.Table.from_batches(simhash._near(4)(iter([pa.RecordBatch.from_arrays([pa.array(chain[i : i + 9])], names=["fp"]) for i in range(0, 63, 9)])))
    assert set(got["a"].to_pylist()) == {0} and set(got["b"].to_pylist()) == {*chain[1:]}


def test_few_plans_for_a_group_of_near_copies(spark, monkeypatch):
    """Copies that differ by a bit or more, dealt over many partitions: few rounds of links, and plans of few steps."""
    rng = random.Random(7)
    base = rng.getrandbits(63)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(0, 4))) for _ in range(1500)} | {rng.getrandbits(63) for _ in range(200)})
    made = []
    old = simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df, name="t": made.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("\n"))) or old(df, name))
    prints = spark.createDataFrame([(i, 0, x) for i, x in enumerate(fps)], "doc_id long, th long, fp long").repartition(16)
    got = {r.fp: r.component_id for r in simhash.grouped(prints).collect()}
    near = [i for i, x in enumerate(fps) if (x ^ base).bit_count() < 4]
    assert {got[fps[i]] for i in near} == {near[0]} and all(got[x] == i for i, x in enumerate(fps) if i not in near)
    assert sum(name == "links" for name, _ in made) <= 6 and max(n for _, n in made) <= 120, made
