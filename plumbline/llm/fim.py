"""Operator 11: fill-in-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` with the regex library keeps every repetition of the group, so ``match.ends(1)`` is the
list of all unit ends: its length is n, and both cuts are read from it by position, without a loop over units. The
hashes that place the cuts and choose the form are SHA-256 digests of seed and key, taken by Spark beforehand; texts are
put together in the same pass, and :func:`restore` rebuilds them with column functions only. There is no shuffle, and a
task holds one Arrow batch and the unit ends of one text.

Defined cases: a null text is the empty text, which has no unit and stays plain; a text that isn't a sequence of units
(no unit matches somewhere) stays plain with n null; a text that holds a sentinel stays plain, so the first sentinels of
an output are always the written ones; a null key is hashed as the empty string; rows that repeat a key get the same
hashes, each for its own text; an empty table gives no rows; a column of the input that has an output's name is
replaced, others pass and can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A unit of the query: any code point, line breaks included.
CODE_POINT = r"(?s:.)"
SENTINELS = ("<P>", "<S>", "<M>")
#: Of a hundred texts so many stay plain, and of a hundred others so many have the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
SEED = "1"
#: Characters of output a batch holds, about.
BATCH_CHARS = 4 << 20
OUTPUTS = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}


def _hashes(key: str, seed: str) -> list[Column]:
    """The first four groups of eight hex digits of sha256(seed:key) as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def cuts(match, h1: int, h2: int) -> tuple[int, int, int]:
    """(n, end of the prefix, end of the middle) of a match of (unit)*, the ends as positions in the text."""
    ends = match.ends(1)
    n = len(ends)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, ends[a - 1] if a else 0, ends[b - 1] if b else 0


def _transformed(unit: str, sentinels: tuple[str, str, str], plain: int, suffix_first: int, rest: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        units, (p, s, m) = regex.compile(f"({unit})*"), sentinels

        def row(text: str, h1: int, h2: int, h3: int, h4: int) -> tuple:
            match = units.fullmatch(text)
            if match is None:
                return None, "plain", None, None, text
            n, a, b = cuts(match, h1, h2)
            if not text or h3 % 100 >= 100 - plain or any(x in text for x in sentinels):
                return n, "plain", None, None, text
            if h4 % 100 < suffix_first:
                return n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
            return n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"

        def closed(kept: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
            made = [pa.array(x, k) for x, k in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
            return pa.RecordBatch.from_arrays([*kept.columns, *made], names=[*rest, *OUTPUTS])

        for batch in batches:
            kept, start, rows, size = pa.RecordBatch.from_struct_array(batch.column(5)), 0, [], 0
            for i, (text, *h) in enumerate(zip(batch.column(0), *(batch.column(j).to_pylist() for j in range(1, 5)))):
                rows.append(row(text.as_py() or "", *h))
                size += len(rows[-1][4])
                if size > BATCH_CHARS:
                    yield closed(kept.slice(start, i + 1 - start), rows)
                    start, rows, size = i + 1, [], 0
            if rows:
                yield closed(kept.slice(start), rows)

    return run


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = CODE_POINT, sentinels: tuple[str, str, str] = SENTINELS, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, seed: str = SEED
) -> DataFrame:
    """``docs`` without ``text``, with n (units), form (plain, psm or spm), prefix_chars, middle_chars and output.

    ``unit`` is a pattern of the regex library, such as one code point, word or line. Prefix and middle end after the
    smaller and the larger of two hashes modulo n + 1 units.
    """
    if len(set(sentinels)) != 3 or any(not x or y in x for x in sentinels for y in sentinels if x != y):
        raise ValueError("three sentinels, none of which is part of another")
    if any(a[i:] == b[: len(a) - i] for a in sentinels for b in sentinels for i in range(1, len(a))):
        raise ValueError("the end of one sentinel must not be the start of another")
    rest = [c for c in docs.columns if c not in (text, *OUTPUTS)]
    hidden = max(["_", *rest], key=len) + "_"  # a struct needs a field even where the text is the only column
    rows = docs.select(F.col(text).alias("text"), *_hashes(key, seed), F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias(hidden)))
    schema = T.StructType([*docs.select([f"`{c}`" for c in rest]).schema.fields, T.StructField(hidden, T.IntegerType()), *[T.StructField(c, k) for c, k in OUTPUTS.items()]])
    return rows.toDF("text", "h1", "h2", "h3", "h4", "rest").mapInArrow(_transformed(unit, tuple(sentinels), plain, suffix_first, [*rest, hidden]), schema).drop(hidden)


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text of an output, by its form."""
    p, s, m = sentinels

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        """What stands after the first, the second and the last sentinel."""
        i = F.locate(second, output)
        j = F.call_function("locate", F.lit(m), output, i + len(second))
        return output.substr(F.lit(len(first) + 1), i - len(first) - 1), output.substr(i + len(second), j - i - len(second)), output.substr(j + len(m), F.char_length(output))

    pre, suf, mid = parts(p, s)
    suf_, pre_, mid_ = parts(s, p)
    return F.when(form == "psm", F.concat(pre, mid, suf)).when(form == "spm", F.concat(pre_, mid_, suf_)).otherwise(output)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
g AS (
  SELECT doc_id, t, length(t) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM g
),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n - b) AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
