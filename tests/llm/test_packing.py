import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import bpe, packing, queries


def whole(rows, sizes, tokens=2048, segments=128, loss=None):
    """Each id lies in one piece, sequences have no gap and keep their limits; returns the share of padding."""
    at, seq = defaultdict(list), defaultdict(list)
    for r in rows:
        at[r[0]].append((r.start, r.length))
        seq[r.sequence_id].append(r)
    for key, n in sizes.items():
        end = 0
        for start, length in sorted(at.pop(key, [])):
            assert start == end and length > 0
            end += length
        assert end == n
    assert not at
    pad = total = 0
    for own in seq.values():
        end = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= tokens and len(own) <= segments and (loss is None or sum(r.loss_tokens for r in own) <= loss)
        pad += 0 if end & (end - 1) == 0 else tokens - end
        total += end
    return pad / max(total, 1)


def test_query(spark):
    from tokenizers import Tokenizer

    sf, t = "/root/testdata/sf0.01", Tokenizer.from_file(queries.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    ids = {r.doc_id: [*t.encode(r.text or "", add_special_tokens=False).ids, 1] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op13_packing(spark, sf).collect()
    assert rows[0].__fields__[0] == "doc_id"
    assert whole(rows, {k: len(x) for k, x in ids.items()}) < 0.001
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())


def test_texts_pack_as_their_ids(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(80).withColumn("length", F.lit("taken"))
    rows = packing.pack_texts(docs, queries.tokenizer_path(), tokens=256, segments=9).collect()
    want = {r.doc_id: r.ids for r in bpe.encode(docs.select("doc_id", "text"), queries.tokenizer_path()).collect()}
    assert {"lang", "source"} <= set(rows[0].__fields__) and "text" not in rows[0].__fields__
    assert whole(rows, {k: len(x) for k, x in want.items()}, 256, 9) < 0.001
    assert all(r.ids == want[r.doc_id][r.start : r.start + r.length] for r in rows)
    assert packing.pack_texts(docs.limit(0), queries.tokenizer_path()).collect() == []


@pytest.mark.parametrize("limits", [(64, 4, 64), (64, 3, 20), (2048, 128, 2048), (7, 1, 7)])
@pytest.mark.parametrize("cut", [True, False])
def test_limits(limits, cut):
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 400):
        sizes = rng.integers(0, 90, n)
        offs = np.concatenate([[0], np.cumsum(sizes)])
        loss = np.concatenate([[0], np.cumsum(rng.random(offs[-1]) < 0.4)])
        found = list(packing.sequences(offs, loss, limits, cut))
        covered = np.zeros(offs[-1], int)
        for own in found:
            assert own and len(own) <= limits[1]
            assert sum(x[2] for x in own) <= limits[0]
            bear = 0
            for i, start, k in own:
                a = offs[i] + start
                assert k > 0 and a + k <= offs[i + 1]
                covered[a : a + k] += 1
                bear += loss[a + k] - loss[a]
            assert bear <= limits[2]
            if cut:
                total = sum(x[2] for x in own)
                assert total == limits[0] or total & (total - 1) == 0
        assert (covered == 1).all()
        if not cut:  # only what a limit forces is cut
            for i in range(n):
                mine = [x for own in found for x in own if x[0] == i]
                if sizes[i] <= limits[0] and loss[offs[i + 1]] - loss[offs[i]] <= limits[2]:
                    assert len(mine) == (sizes[i] > 0)


def test_dot_product_balances_dimensions():
    """Examples rich in loss and examples without: taken by size alone each kind would fill one dimension and waste the other."""
    sizes = np.array([30] * 20 + [31] * 20)
    offs = np.concatenate([[0], np.cumsum(sizes)])
    bears = np.concatenate([np.ones(600, int), np.zeros(620, int)])
    loss = np.concatenate([[0], np.cumsum(bears)])
    found = list(packing.sequences(offs, loss, (61, 8, 30), cut=False))
    assert len(found) == 20 and all(sorted(x[0] < 20 for x in own) == [False, True] for own in found)


def test_choice_is_the_largest_dot_product():
    pool = packing._Pool((100, 10, 50))
    kinds = [(10, 0), (40, 40), (60, 5), (90, 1), (30, 30)]
    for j, (t, s) in enumerate(kinds):
        pool.add(t, s, (j, 0))
    total = [sum(k[0] for k in kinds) / 100, len(kinds) / 10, sum(k[1] for k in kinds) / 50]
    for room in ((100, 10, 50), (70, 3, 10), (35, 2, 30), (5, 1, 0)):
        dot = {j: sum(w / sum(total) * r / c * x / c for w, r, c, x in zip(total, room, (100, 10, 50), (t, 1, s))) for j, (t, s) in enumerate(kinds) if t <= room[0] and s <= room[2]}
        assert pool.best(room, True) == (max(dot, key=dot.get) if dot else -1)


def test_conversations_with_loss_on_replies(spark, sf):
    """Instruction data: an example is a conversation, a token a word, and only the assistant's words bear loss."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet").withColumn("words", F.split(F.coalesce("text", F.lit("")), " "))
    turns = turns.select("conv_id", "turn", F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(1000)).cast("int")).alias("ids"), F.transform("words", lambda w: F.col("role") == "assistant").alias("bears"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "ids", "bears"))).alias("t")).select("conv_id", F.flatten("t.ids").alias("ids"), F.flatten("t.bears").alias("bears")).repartition(2)
    told = {r.conv_id: r for r in chats.collect()}
    rows = packing.pack(chats, loss="bears", tokens=512, segments=16, loss_tokens=200, cut=False).collect()
    whole(rows, {k: len(r.ids) for k, r in told.items()}, 512, 16, 200)
    for r in rows:
        own = told[r.conv_id]
        assert r.ids == own.ids[r.start : r.start + r.length] and r.loss_tokens == sum(own.bears[r.start : r.start + r.length])
    assert any(r.loss_tokens < r.length for r in rows)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "LOT_TOKENS", 50)
    monkeypatch.setattr(packing, "LOT_ROWS", 7)
    monkeypatch.setattr(packing, "BATCH_TOKENS", 20)
    data = [(1, None, None, 5), (2, [], [], 5), (3, [7, None, 9], [False], 5), (3, [7, None, 9], None, 5), (None, list(range(300)), None, 5)] + [(10 + i, [i] * (i % 9), [True, False] * 4, 5) for i in range(60)]
    df = spark.createDataFrame(data, "k long, ids array<int>, bears array<boolean>, start int").repartition(3)
    rows = packing.pack(df, loss="bears", tokens=32, segments=4, loss_tokens=16, end=1).collect()
    assert sum(r.length for r in rows) == sum(len(x[1] or []) + 1 for x in data)
    assert {tuple(r.ids) for r in rows if r.k == 1} == {(1,)}
    assert sum(r.loss_tokens for r in rows if r.k == 3) == 3 + 4  # what the mask doesn't say bears loss
    assert 0 in {x for r in rows if r.k == 3 for x in r.ids}
    assert packing.pack(df.limit(0)).collect() == []
    assert sum(r.length for r in packing.pack(df.select("ids")).collect()) == sum(len(x[1] or []) for x in data)
    with pytest.raises(ValueError):
        packing.pack(df, segments=0)
