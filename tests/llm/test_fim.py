import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from plumbline.llm import fim

ODD = [None, "", "a", "\n", "<P>", "x <M> y", "ends with <", "<<S", "a\r\nb\x00c", "🙂é漢́", "ab " * 3000, "<P", "S>M>", "same", "same"]


def expected(doc_id, text):
    """The contract, read off one code point after another."""
    t = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n, units = 0, []
    for c in t:
        units.append(c)
        n += 1
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h3 % 100 >= 90:
        return n, "plain", None, None, t
    if h4 % 100 < 20:
        return n, "spm", a, b - a, "<S>" + suf + "<P>" + pre + "<M>" + mid
    return n, "psm", a, b - a, "<P>" + pre + "<S>" + suf + "<M>" + mid


def test_outputs_and_restoration(spark):
    rows = [(None if i == 5 else i, t) for i, t in enumerate(ODD * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = fim.transform(df.withColumn("source", F.col("text"))).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    want = sorted(map(repr, ((i, *expected(i, t)) for i, t in rows)))
    assert sorted(repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in got) == want
    assert all(r.back == (r.source or "") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    got = sorted(map(repr, map(tuple, fim.op11(spark, sf).select(*names).collect())))
    assert got == sorted(map(repr, con.sql(f"SELECT {', '.join(names)} FROM ({fim.OP11_SQL})").fetchall()))


def test_other_units_and_sentinels(spark):
    df = spark.createDataFrame([(i, f"one two{'  three' * i}\nfour") for i in range(40)] + [(40, " starts blank")], "doc_id long, text string")
    marks = ("[[pre]]", "[[suf]]", "[[mid]]")
    got = fim.transform(df, unit=r"\S+\s*", sentinels=marks, plain=0, suffix_first=50).withColumn("back", fim.restore(F.col("output"), F.col("form"), marks)).collect()
    texts = dict(df.collect())
    for r in got:
        words = texts[r.doc_id].split()
        if r.doc_id == 40:
            assert (r.n, r.form) == (None, "plain")
            continue
        assert r.n == len(words) and r.back == texts[r.doc_id] and r.form != "plain"
        assert texts[r.doc_id][: r.prefix_chars] == "" or texts[r.doc_id][r.prefix_chars - 1].isspace() or r.prefix_chars == len(texts[r.doc_id])
    assert len({r.form for r in got}) == 3


def test_edges(spark):
    only = spark.createDataFrame([("k",)], "text string").select("text")
    assert fim.transform(only.withColumn("n", F.lit(9)), key="n").count() == 1
    clash = spark.createDataFrame([(1, "abc", 5, "x", "y")], "doc_id long, text string, n int, _ string, form string")
    (r,) = fim.transform(clash).collect()
    assert r.n == 3 and tuple(r.__fields__) == ("doc_id", "_", *fim.OUTPUTS) and r["_"] == "x"
    assert fim.transform(clash.limit(0)).collect() == []
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P>", "<P>x", "<M>"), ("ab", "bc", "<M>")):
        with pytest.raises(ValueError):
            fim.transform(clash, sentinels=bad)
