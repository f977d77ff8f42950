import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from plumbline.llm import bpe, queries, sharding, urls

ODD = [None, "", " ", "\n", "a", "<|endoftext|>", "x<|endoftext|> y <|endoftext|", "don't 'tis '' 'S we'll", "  two   spaces \n\n tab\t", "½ ² ٣٤ 漢字 émile ñandú", "\x1c\x85\xa0z", "🙂🙂 a\u0301", "aaaa" * 500, "1234567890 " * 3]


def lib():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.mark.parametrize("bounds", [{}, {"task_words": 0, "lot_buckets": 7}, {"task_words": 50, "lot_buckets": 1}])
def test_bpe_equals_library(spark, sf, bounds):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, ids int").repartition(3)
    got = {r.doc_id: (r.ids, r.decoded) for r in bpe.decode(bpe.encode(df, queries.tokenizer_path(), **bounds), queries.tokenizer_path()).collect()}
    t = lib()
    for i, x in enumerate(texts):
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert got[i] == (ids, t.decode(ids, skip_special_tokens=False)), x


def test_bpe_refuses_other_files():
    import json

    told = json.loads(bpe._spec(queries.tokenizer_path()))
    for change in ({"pre_tokenizer": told["pre_tokenizer"] | {"use_regex": False}}, {"model": told["model"] | {"ignore_merges": True}}, {"model": told["model"] | {"dropout": 0.1}}, {"added_tokens": [told["added_tokens"][0] | {"lstrip": True}]}):
        with pytest.raises(ValueError):
            bpe.Codec(json.dumps(told | change))


def test_bpe_encodes_each_word_once():
    """Two lots that share words, in one bucket task: as many words reach the tokenizer as there are distinct ones."""
    import pyarrow as pa

    spec = bpe._spec(queries.tokenizer_path())
    told = type("Told", (), {"value": spec})
    words = ["the", " end", " the", " of"]
    body = lambda ws: bpe._packed(bpe._planes(bpe.np.array([len(w) for w in ws]), 4), "".join(ws).encode())
    batch = bpe._rows([(0, "a", False, body(words[:3])), (0, "b", False, body(words)), (None, "a", None, b"x")])
    seen, codec = [], bpe._codec(spec)
    real = codec.encode
    codec.encode = lambda ws: (seen.extend(ws), real(ws))[1]
    try:
        (out,) = bpe._answers(told, 10)(iter([batch]))
    finally:
        codec.encode = real
    assert sorted(seen) == sorted(words) and isinstance(out, pa.RecordBatch) and out.num_rows == 3


def test_bpe_lots_hold_little(monkeypatch):
    """A lot of many long words is dealt in pieces, with the same buckets, and without a tokenizer in memory."""
    import pyarrow as pa
    import pyspark

    from plumbline.llm import textarrays as ta

    monkeypatch.setattr(pyspark, "TaskContext", type("C", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 0)}))}))
    spec = bpe._spec(queries.tokenizer_path())
    texts = [" ".join(f"{chr(97 + i % 26) * 12}{i}x" for i in range(k, k + 1000)) for k in range(0, 60_000, 1000)] + ["y" * (bpe.HASHED + 9)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.StructArray.from_arrays([pa.array(range(len(texts)))], ["doc_id"])], ["text", "rest"])
    bpe._codec.cache_clear()
    ta.give_back()
    rows = [r for b in bpe._lots(type("Told", (), {"value": spec}), 7)(iter([batch])) for r in b.to_pylist()]
    assert len(ta._POWERS[0]) <= 4 * bpe.HASHED and bpe._codec(spec)._tokenizer is None
    dealt = {}
    for r in rows:
        if r["answer"] is False:
            sizes, data = bpe._unpacked(r["body"])
            ends = bpe.np.cumsum(bpe._from_planes(sizes, 4)).tolist()
            dealt |= {data[a:b]: r["part"] for a, b in zip([0, *ends], ends)}
    words = {w.encode() for t in texts for w in bpe._codec(spec).words(t)}
    data, offs = bpe.np.frombuffer(b"".join(dealt), bpe.np.uint8), bpe.np.cumsum([0, *map(len, dealt)])
    assert set(dealt) == words and (ta.span_hash(data, offs[:-1], offs[1:]) % ta.U64(7)).tolist() == [*dealt.values()]


def test_bpe_digest_and_empty(spark):
    df = spark.createDataFrame([(1, "the end"), (1, "the end"), (2, None)], "doc_id long, text string")
    rows = bpe.digest(df, queries.tokenizer_path()).collect()
    assert len(rows) == 3
    assert {r.ids_sha256 for r in rows if r.doc_id == 2} == {hashlib.sha256(b"").hexdigest()}
    assert bpe.digest(df.limit(0), queries.tokenizer_path()).collect() == []
    bad = spark.createDataFrame([([1, None, 10**6],), (None,)], "ids array<int>")
    assert len(bpe.decode(bad, queries.tokenizer_path()).collect()) == 2


def test_fill_shares_and_stability():
    a = sharding.fill(sharding.SHARDS, sharding.TABLE_SIZE)
    sizes = [a.count(i) for i in range(16)]
    assert max(sizes) - min(sizes) <= 1
    b = sharding.fill(sharding.SHARDS[:-1], sharding.TABLE_SIZE)
    kept = sum(x == y for x, y in zip(a, b) if x != 15) / sum(x != 15 for x in a)
    assert kept > 0.7
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(bad, 7)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 8)


def test_assign_edges(spark, tmp_path):
    df = spark.createDataFrame([("x", 1, 9), ("x", 2, 9), (None, 3, 9), ("", 4, 9)], "k string, slot int, n int")
    rows = sharding.assign(df, "k").collect()
    assert len(rows) == 4 and all(r.shard for r in rows) and len({r.shard for r in rows if r.k == "x"}) == 1
    assert sharding.assign(df.limit(0), "k").count() == 0
    sharding.write(df, str(tmp_path / "o"), "k")
    assert spark.read.parquet(str(tmp_path / "o")).count() == 4


def test_urls_against_sql(spark):
    odd = [None, "", "no scheme", "http://", "http://net", "http://NET/", "https://a.Example.net/en/x?y#z", "http://xnet/", "http://example.net/de/", "http://b.example.com/de/1", "http://q.org/fr/", "http://q.org/en/",
           "http://www.q.org/en", "http://m.q.org/en//", "http://h?x=/a", "http://h#://b", "a://b://c/d", "http://é.org/FR/", "http://net:80/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(odd + odd[4:9])], "page_id long, url string, host string")
    got = sorted(map(tuple, urls.judge(df, urls.repeated(df)).select("page_id", "host", "path", "rule", "verdict").collect()))
    pages = df.toPandas()
    con = duckdb.connect()
    con.register("pages", pages)
    assert got == sorted(con.sql(urls.OP2_SQL).fetchall())
    assert urls.judge(df.limit(0), urls.repeated(df)).count() == 0
    assert urls.judge(df, urls.repeated(df.limit(0)), rules=[]).where("verdict = 'block'").count() == 0


def test_urls_clashing_columns(spark):
    names = ["block", "canonical", "m0", "_fit", "_key", "row", "verdict", "salt"]
    df = spark.createDataFrame([(i, u, *range(8)) for i, u in enumerate(["http://a.io/x", "http://a.io/x", "http://b.net/", None])], "page_id long, url string, " + ", ".join(f"{x} int" for x in names))
    rows = sorted(urls.judge(df, urls.repeated(df)).collect())
    assert [r.verdict for r in rows] == ["block", "block", "block", "allow"] and all((r.block, r.canonical, r.m0, r._fit, r._key, r.row, r.salt) == (0, 1, 2, 3, 4, 5, 7) for r in rows)


def test_urls_large_list_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_LIST", 0)
    monkeypatch.setattr(urls, "BROADCAST_BLOCKS", 0)
    df = spark.range(2000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.io/"), (F.col("id") % 1500).cast("string")).alias("url"))
    listed = df.where("page_id < 400").select("url")
    got = urls.judge(df, listed, rules=[])
    assert got.count() == 2000
    assert got.where("verdict = 'block'").count() == 400 + 400
