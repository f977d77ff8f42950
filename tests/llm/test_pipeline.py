import corpus_pipeline as cp
from tests.llm import test_decontam, test_simhash, test_substrings

from plumbline.llm import queries


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cols = docs.columns
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    names = [n for n, _ in cp.STAGES]
    assert len(names) == 5
    kept, seen = docs, {}
    for name, stage in cp.STAGES:
        before = [(r.doc_id, r.text) for r in kept.collect()]
        kept = cp.stored(stage(spark, kept, sf), "test")
        after = kept.collect()
        seen[name] = (before, after)
        if name != names[-1]:
            assert kept.columns == cols
    before, after = seen["toxicity"]
    gone = {d for d, _ in before} - {r.doc_id for r in after}
    assert sum(toxic[d] for d in gone if d in toxic) >= 0.8 * sum(toxic.values())
    before, after = seen["simhash_near_dedup"]
    assert {r.doc_id for r in after} == {c for _, _, c in test_simhash.brute(before)} and len(after) == len({r.doc_id for r in after})
    before, after = seen["suffix_array_dedup"]
    want = {d: removed for d, _, removed, _, _ in test_substrings.brute(before)}
    texts = dict(before)
    assert len(after) == len(before)
    assert all(len(r.text.encode()) <= len(texts[r.doc_id].encode()) - want[r.doc_id] <= len(r.text.encode()) + 40 and r.n_chars == len(r.text) for r in after)
    before, after = seen["benchmark_decontamination"]
    assert {r.doc_id for r in after} == {x[0] for x in test_decontam.brute(before, items) if not x[5]}
    before, after = seen["bpe"]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    assert {r.doc_id: r.ids for r in after} == {d: t.encode(x or "", add_special_tokens=False).ids for d, x in before}


def test_clashing_columns(spark):
    """All stages but the last return the columns of documents as they were, whatever the columns are called."""
    names = ["_grade", "_severity", "_id", "_th", "severity", "grade", "row", "id", "th", "n", "spans", "ids", "key"]
    rows = [(i, f"some words of a text number {i} and more of them", *range(len(names))) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{x} long" for x in names))
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", *names]
        assert {tuple(r)[2:] for r in docs.collect()} == {tuple(range(len(names)))}
    assert cp.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == docs.count()


def test_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "a b c d e f", "en", "s", 3), (3, "a b c d e f", "en", "s", 3), (3, "a b c d e f", "en", "s", 3), (4, "é" * 100, "x", "y", 100), (5, "q" + "é" * 100, "x", "y", 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        kept = docs.limit(0) if empty else docs
        for _, stage in cp.STAGES:
            kept = cp.stored(stage(spark, kept, "/root/testdata/sf0.001"), "test")
        assert kept.count() == (0 if empty else 4)
