"""Operator 13: packing into sequences under simultaneous limits, by the dot-product heuristic of vector bin packing.

An example is a list of token ids; what it asks of a sequence is a vector of tokens, segments (one a piece) and
loss-bearing tokens, and a sequence has a limit of each. A task packs lots of consecutive examples (``LOT_TOKENS``): a
sequence is opened and takes, again and again, the piece that fits and has the largest dot product of its vector and the
room that is left, each dimension relative to its limit and weighted by its share in the lot's demand. Pieces of the same
vector are one kind, so a choice looks at kinds and not at pieces. Where no piece fits the room, and cutting is allowed,
the best piece is cut to fit and its rest goes back. Only the lot's bounds meet the corpus: no shuffle, and no sequence
crosses a lot. A sequence that closes below its limit of tokens is cut at falling powers of two, whose sequences need no
padding.

Defined cases: a null list is an empty example; an example without ids has no piece (with an end id it has one token);
an example above a limit is cut at the limit, also where cutting is not asked for; a loss mask shorter than its ids, or
null, counts as bearing loss where it says nothing; null ids are taken as 0; repeated rows and keys are packed row by row;
an empty table gives no rows; a column of the input that has an output's name is replaced. Sequence ids are a task's
partition and a count with gaps, so the input must give the same rows when a lost task is run again, as scans, stored tables and
sorted shuffles do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm import bpe

TOKENS, SEGMENTS = 2048, 128
#: Tokens, and examples, of a lot.
LOT_TOKENS, LOT_ROWS = 4 << 20, 20_000
#: Tokens that a batch of pieces holds, about.
BATCH_TOKENS = 1 << 20
OUTPUTS = {"start": T.LongType(), "length": T.LongType(), "loss_tokens": T.LongType(), "example_tokens": T.LongType(), "sequence_id": T.LongType(), "offset": T.LongType()}


class _Pool:
    """Pieces that wait for a sequence, by kind (tokens, loss-bearing tokens)."""

    def __init__(self, limits: tuple[int, int, int]):
        self.limits, self.kind, self.pieces = np.array(limits, float), {}, []
        self.tokens, self.loss, self.count = (np.zeros(64, np.int64) for _ in range(3))
        self.demand, self.size = np.zeros(3), 0

    def add(self, tokens: int, loss: int, piece: tuple[int, int]) -> None:
        k = self.kind.setdefault((tokens, loss), len(self.pieces))
        if k == len(self.pieces):
            self.pieces.append([])
            if k == len(self.tokens):
                self.tokens, self.loss, self.count = (np.concatenate([x, np.zeros(k, np.int64)]) for x in (self.tokens, self.loss, self.count))
            self.tokens[k], self.loss[k] = tokens, loss
        self.pieces[k].append(piece)
        self.count[k] += 1
        self.size += 1
        self.demand += (tokens, 1, loss)

    def best(self, room: tuple[int, int, int], fitting: bool) -> int:
        """The kind with the largest dot product with the room, among those that fit or among all; -1 if there is none."""
        n = len(self.pieces)
        share = self.demand / self.limits
        w = share / max(share.sum(), 1e-9) * np.array(room) / self.limits**2
        at = self.count[:n] > 0
        if fitting:
            at &= (self.tokens[:n] <= room[0]) & (self.loss[:n] <= room[2])
        if not at.any():
            return -1
        return int(np.argmax(np.where(at, w[0] * self.tokens[:n] + w[1] + w[2] * self.loss[:n], -1.0)))

    def take(self, k: int) -> tuple[int, int, tuple[int, int]]:
        tokens, loss = int(self.tokens[k]), int(self.loss[k])
        self.count[k] -= 1
        self.size -= 1
        self.demand -= (tokens, 1, loss)
        return tokens, loss, self.pieces[k].pop()


def sequences(offs: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int], cut: bool = True) -> Iterator[list[tuple[int, int, int]]]:
    """The sequences of a lot, each a list of pieces (example, start, length).

    Example i has the tokens offs[i] to offs[i + 1]; ``loss[j]`` of the first j tokens bear loss; ``limits`` are tokens,
    segments and loss-bearing tokens of a sequence.
    """
    most, segments, bearing = limits

    def prefix(first: int, last: int, tokens: int, bear: int) -> int:
        """So many tokens from ``first`` on stay within the two limits."""
        return min(last - first, tokens, int(np.searchsorted(loss, loss[first] + bear, "right")) - 1 - first)

    pool = _Pool(limits)
    for i, (lo, hi) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
        at = lo
        while at < hi:
            n = prefix(at, hi, most, bearing)
            if n == most:  # fills a sequence alone
                yield [(i, at - lo, n)]
            else:
                pool.add(n, int(loss[at + n] - loss[at]), (i, at - lo))
            at += n
    while pool.size:
        room, own = limits, []
        while pool.size and room[0] and room[1]:
            k = pool.best(room, True)
            if k < 0 and (not cut or (k := pool.best(room, False)) < 0):
                break
            tokens, bear, (i, start) = pool.take(k)
            first = int(offs[i]) + start
            n = prefix(first, first + tokens, room[0], room[2])
            if n < tokens:
                used = int(loss[first + n] - loss[first])
                pool.add(tokens - n, bear - used, (i, start + n))
                bear = used
            if not n:
                break
            own.append((i, start, n))
            room = room[0] - n, room[1] - 1, room[2] - bear
        yield from _powers(own, most) if cut else [own]


def _powers(own: list[tuple[int, int, int]], most: int) -> Iterator[list[tuple[int, int, int]]]:
    """A sequence below ``most`` tokens, cut at falling powers of two."""
    total = sum(n for *_, n in own)
    if total == most:
        yield own
        return
    own = own[::-1]
    while total:
        left, part = 1 << (total.bit_length() - 1), []
        total -= left
        while left:
            i, start, n = own.pop()
            if n > left:
                own.append((i, start + left, n - left))
            part.append((i, start, min(n, left)))
            left -= part[-1][2]
        yield part


def _lot(table: pa.Table, flat: np.ndarray, offs: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int], cut: bool, first: int, name: str, finish) -> Iterator[pa.RecordBatch]:
    """The pieces of a lot's examples (the rows of ``table``) in sequences numbered from ``first`` on.

    Rows have the columns of ``table``, ``OUTPUTS`` and, as ``name``, what ``finish`` makes of the ids of each piece.
    """
    rows, held = [], 0

    def closed() -> pa.RecordBatch:
        i, start, n, seq, at = np.array(rows, np.int64).reshape(-1, 5).T
        begin = offs[i] + start
        own = table.take(pa.array(i)).combine_chunks().to_batches()[0]
        made = [start, n, loss[begin + n] - loss[begin], offs[i + 1] - offs[i], seq, at]
        return pa.RecordBatch.from_arrays([*own.columns, *map(pa.array, made), finish([flat[a : a + k] for a, k in zip(begin.tolist(), n.tolist())])], names=[*table.column_names, *OUTPUTS, name])

    for sequence in sequences(offs, loss, limits, cut):
        at = 0
        for i, start, n in sequence:
            rows.append((i, start, n, first, at))
            at += n
        first, held = first + 1, held + at
        if held >= BATCH_TOKENS:
            yield closed()
            rows, held = [], 0
    if rows:
        yield closed()


class _Numbers:
    """Sequence ids of the task at hand: its partition, and a count."""

    def __init__(self):
        self.task, self.next = None, 0

    def take(self, n: int) -> int:
        from pyspark import TaskContext

        at = TaskContext.get()
        if self.task != at.taskAttemptId():
            self.task, self.next = at.taskAttemptId(), at.partitionId() << 33
        self.next += n
        return self.next - n


def _pieces(limits: tuple[int, int, int], cut: bool, end: int | None, rest: list[str], name: str, finish):
    """Lots of consecutive rows (ids, loss, the columns ``rest``), packed."""
    numbers = _Numbers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, masks, kept, sizes, waiting = [], [], [], [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            offs = np.concatenate([[0], np.cumsum(sizes)])
            flat = np.concatenate([np.zeros(0, np.uint32), *ids])
            loss = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, bool), *masks]))])
            yield from _lot(pa.Table.from_batches(kept), flat, offs, loss, limits, cut, numbers.take(len(flat)), name, finish)

        for batch in batches:
            own, begun = pa.RecordBatch.from_struct_array(batch.column(2)), 0
            for i, (x, mask) in enumerate(zip(batch.column(0), batch.column(1))):
                told = np.asarray(x.values.fill_null(0), np.int64) if x.is_valid else np.zeros(0, np.int64)
                told = np.append(told, end) if end is not None else told
                bears = np.ones(len(told), bool)
                if mask.is_valid:
                    said = mask.values.fill_null(True).to_numpy(zero_copy_only=False)[: len(told)]
                    bears[: len(said)] = said
                ids.append(told.astype(np.uint32))
                masks.append(bears)
                sizes.append(len(told))
                waiting += len(told)
                if len(sizes) >= LOT_ROWS or waiting >= LOT_TOKENS:
                    kept.append(own.slice(begun, i + 1 - begun))
                    begun = i + 1
                    yield from packed()
                    ids, masks, kept, sizes, waiting = [], [], [], [], 0
            if begun < batch.num_rows:
                kept.append(own.slice(begun))
        if sizes:
            yield from packed()

    return run


def _packed(examples: DataFrame, ids: str, loss: str | None, limits: tuple[int, int, int], cut: bool, end: int | None, finish, kind: T.DataType) -> DataFrame:
    if min(limits) < 1:
        raise ValueError("a sequence needs room for a token, a segment and a loss-bearing token")
    rest = [c for c in examples.columns if c not in (ids, loss, *OUTPUTS)]
    hidden = max(["_", *rest], key=len) + "_"  # a struct needs a field even where the ids are the only column
    mask = F.col(f"`{loss}`") if loss else F.lit(None)
    rows = examples.select(F.col(f"`{ids}`").cast("array<long>"), mask.cast("array<boolean>"), F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias(hidden)))
    fields = examples.select([f"`{c}`" for c in rest]).schema.fields
    schema = T.StructType([*fields, T.StructField(hidden, T.IntegerType()), *[T.StructField(c, k) for c, k in OUTPUTS.items()], T.StructField(ids, kind)])
    return rows.toDF("ids", "loss", "rest").mapInArrow(_pieces(limits, cut, end, [*rest, hidden], ids, finish), schema).drop(hidden)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offs = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate([np.zeros(0, np.uint32), *parts]).astype(np.int32)))


def pack(
    examples: DataFrame, ids: str = "ids", loss: str | None = None, tokens: int = TOKENS, segments: int = SEGMENTS, loss_tokens: int | None = None, cut: bool = True, end: int | None = None
) -> DataFrame:
    """One row per piece: the other columns of its example, ``OUTPUTS`` and the piece's own ids.

    ``ids`` is a list of numbers, ``loss`` a list of booleans beside it (all true if not given), ``end`` an id that closes
    each example. ``loss_tokens`` is the limit of loss-bearing tokens (none unless given). Without ``cut`` examples within
    the limits stay whole.
    """

    return _packed(examples, ids, loss, (tokens, segments, loss_tokens or tokens), cut, end, _lists, T.ArrayType(T.IntegerType()))


def pack_texts(docs: DataFrame, tokenizer: str, text: str = "text", tokens: int = TOKENS, segments: int = SEGMENTS, end: int | None = None, name: str = "ids", finish=None, kind: T.DataType | None = None) -> DataFrame:
    """:func:`pack` of the ids of whole texts, packed in the task that puts a text's ids together; every id bears loss.

    The ids of texts never leave that task: a row a piece does. ``finish`` makes the column ``name`` of the ids of pieces.
    """
    rest = [c for c in docs.columns if c not in (text, name, *OUTPUTS)]
    numbers, limits, made_of = _Numbers(), (tokens, segments, tokens), finish or _lists

    def packed(codec, kept: pa.Table, flat: np.ndarray, offs: np.ndarray) -> pa.Table:
        if end is not None:
            flat = np.insert(flat.astype(np.uint32), offs[1:], end)
            offs = offs + np.arange(len(offs))
        batches = _lot(kept, flat, offs, np.arange(len(flat) + 1), limits, True, numbers.take(len(flat)), name, made_of)
        return pa.Table.from_batches(batches, pa.schema([*kept.schema, *[(c, pa.int64()) for c in OUTPUTS], (name, made_of([]).type)]))

    fields = docs.select([f"`{c}`" for c in rest]).schema.fields
    schema = T.StructType([*fields, *[T.StructField(c, k) for c, k in OUTPUTS.items()], T.StructField(name, kind or T.ArrayType(T.IntegerType()))])
    return bpe._encoded(docs, tokenizer, text, rest, packed, schema)


def op13(spark: SparkSession, sf_dir: str, tokenizer: str) -> DataFrame:
    """All documents as pieces of sequences of 2,048 tokens; id 1 closes a document, every id bears loss."""

    def finish(parts: list[np.ndarray]) -> pa.Array:
        return pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in parts], pa.int64())

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = pack_texts(docs, tokenizer, end=1, name="ids_crc32", finish=finish, kind=T.LongType())
    return made.withColumnsRenamed({"example_tokens": "doc_tokens"})
