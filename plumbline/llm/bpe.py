"""Operator 10: byte-level BPE by a distinct-word table.

1. Tasks split the texts of a lot (``LOT_BYTES`` of text) into words and number the lot's distinct words. A lot sends
   one packed row to each bucket that its words hash to, and one row with the word numbers of its texts by position.
2. Bucket tasks encode each distinct word once for all lots, and answer each lot's row with the ids of its words.
3. The answers meet the lot's word numbers again (a join by lot and position), and ids are taken by number. So a word
   that a third of all texts have travels once a lot, texts never travel, and no lot or task holds more than a bound.
4. Decoding joins ids with the pieces of the vocabulary, which is as large as the tokenizer and no larger.

A bucket task keeps ``TASK_WORDS`` encoded words at most; beyond that it starts anew and a word may be encoded again,
with the same ids. ``docs`` must give the same rows when a lost task is run again, as scans and stored tables do; a lot
that doesn't fit its answers is an error, never a wrong result.

Defined cases: a null or empty text has no ids and decodes to the empty text; the string of an added token (such as
<|endoftext|>) becomes that token's id, as in the tokenizers library; repeated rows and doc_ids are encoded row by row;
an empty table gives no rows; a column of the input that has an output's name is replaced, others travel packed and
can't clash. Tokenizer files with options that this codec doesn't follow are refused.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm import textarrays as ta

#: Text and distinct words of a lot.
LOT_BYTES = 24 << 20
LOT_WORDS = 400_000
#: Text for which there is one bucket of words, and buckets at most: a lot sends a row to each.
BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 16_384
#: Encoded words that a bucket task keeps.
TASK_WORDS = 1_000_000
#: Words of a lot whose ids are put together at once.
PART_WORDS = 400_000
#: Words that the tokenizer encodes at once: it keeps some kilobyte of each until they are read.
ENCODED = 4_096
#: Bytes of words that are hashed at once.
HASHED = 128 << 10
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _splitter(pattern: str):
    """findall of ``pattern``; texts of common characters only go through ``re``, which is three times as fast."""
    import regex

    exact = regex.compile(pattern)
    common = [chr(i) for i in (*range(0x250), *range(0x2010, 0x2028))]
    kinds = {p: "".join(re.escape(c) for c in common if regex.match(p, c)) for p in (r"\p{L}", r"\p{N}", r"\s")}
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", "[^" + "".join(kinds.values()) + "]")
    plain = plain.replace(r"\p{L}", f"[{kinds[r'\p{L}']}]").replace(r"\p{N}", f"[{kinds[r'\p{N}']}]")
    plain = plain.replace(r"\S", f"[^{kinds[r'\s']}]").replace(r"\s", f"[{kinds[r'\s']}]")
    fast, rare = re.compile(plain), re.compile("[^\x00-ɏ‐-‧]")
    return lambda text: exact.findall(text) if rare.search(text) else fast.findall(text)


class Codec:
    """What a task needs of a tokenizer file of the byte-level BPE kind."""

    def __init__(self, spec: str):
        told = json.loads(spec)
        kind, pre = told["model"]["type"], told["pre_tokenizer"] or {}
        if kind != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or told["normalizer"] or not pre.get("use_regex", True):
            raise ValueError("only byte-level BPE with its own splitting, without normalizer and prefix space")
        if any(told["model"].get(x) for x in ("dropout", "ignore_merges", "byte_fallback", "continuing_subword_prefix", "end_of_word_suffix", "unk_token")):
            raise ValueError("only plain byte-level BPE, without dropout, ignored merges, fallback, affixes or an unknown token")
        if any(t.get(x) for t in told["added_tokens"] for x in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only added tokens that match exactly where they stand")
        self.spec = spec
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.split = _splitter(SPLIT)
        self.most = max([*told["model"]["vocab"].values(), *self.added.values()])
        self.id_kind = np.uint16 if self.most < 1 << 16 else np.int32
        self._tokenizer = self._pieces = self._numbers = None

    @property
    def tokenizer(self):
        """Made when the first word is encoded: tasks that split or decode do without its memory."""
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            made = Tokenizer.from_str(self.spec)
            made.no_truncation()
            made.no_padding()
            made.encode_special_tokens = True
            self._tokenizer = made
        return self._tokenizer

    def words(self, text: str) -> list[str]:
        if self.cut is None or not self.cut.search(text):
            return self.split(text)
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            out += [part] if i % 2 else self.split(part)
        return out

    def encode(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for lo in range(0, len(words), ENCODED):
            part = words[lo : lo + ENCODED]
            done = self.tokenizer.encode_batch(part, add_special_tokens=False)
            out += [[self.added[w]] if w in self.added else x.ids for w, x in zip(part, done, strict=True)]
        return out

    def numbers(self) -> pa.Array:
        """Each id in decimal digits with a comma."""
        if self._numbers is None:
            self._numbers = pa.array([b"%d," % i for i in range(self.most + 1)], pa.binary())
        return self._numbers

    def pieces(self) -> pa.Array:
        """The bytes of each id; ids without a piece are empty."""
        if self._pieces is None:
            self._pieces = self._made_pieces()
        return self._pieces

    def _made_pieces(self) -> pa.Array:
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*shown}))}
        out = [b""] * (self.most + 1)
        for piece, i in (json.loads(self.spec)["model"]["vocab"] | self.added).items():
            out[i] = piece.encode() if piece in self.added else bytes(byte_of[c] for c in piece)
        return pa.array(out, pa.binary())


@lru_cache(maxsize=1)
def _codec(spec: str) -> Codec:
    """One codec for all tasks of a worker process."""
    return Codec(spec)


def _spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


_KIND = "part long, lot string, answer boolean, body binary"
_ZSTD = pa.Codec("zstd", compression_level=1)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, (pa.int64(), pa.string(), pa.bool_(), pa.binary()))], names=["part", "lot", "answer", "body"])


def _packed(*parts: bytes) -> bytes:
    """The parts, each compressed, after the number of them and their sizes."""
    z = [_ZSTD.compress(x, asbytes=True) if x else b"" for x in parts]
    return np.array([len(z), *map(len, parts), *map(len, z)], np.int64).tobytes() + b"".join(z)


def _unpacked(raw: bytes) -> list[bytes]:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, 2 * n, 8).tolist()
    out, at = [], 8 + 16 * n
    for full, z in zip(sizes[:n], sizes[n:]):
        out.append(_ZSTD.decompress(raw[at : at + z], full, asbytes=True) if full else b"")
        at += z
    return out


def _planes(x: np.ndarray, size: int) -> bytes:
    """The lower bytes of all values, then the next: small numbers compress better so."""
    return np.ascontiguousarray(x.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T).tobytes()


def _from_planes(raw: bytes, size: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(f"<u{size}").ravel().astype(np.int64)


def _numbers(rank: np.ndarray) -> tuple[bytes, bytes]:
    """Word numbers by frequency: a byte for each of the 255 most frequent, and four more, in planes, for the others."""
    often = rank < 255
    return np.minimum(rank, 255).astype(np.uint8).tobytes(), _planes(rank[~often], 4)


def _from_numbers(one: bytes, more: bytes) -> np.ndarray:
    out = np.frombuffer(one, np.uint8).astype(np.uint32)
    out[out == 255] = _from_planes(more, 4)
    return out


def _dealt(data: np.ndarray, offs: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each word, hashed some bytes at a time: hashing takes some 50 bytes of memory for each."""
    out, lo = np.zeros(len(offs) - 1, np.int64), 0
    while lo < len(out):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + HASHED, "right")) - 1)
        own = offs[lo : hi + 1] - offs[lo]
        out[lo:hi] = ta.span_hash(data[offs[lo] : offs[hi]], own[:-1], own[1:]) % ta.U64(buckets)
        lo = hi
    return out


def _lots(told, buckets: int):
    """Rows of ``_KIND``: each lot's distinct words by bucket (answer false, part the bucket), and its word numbers (answer null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        codec, task, made = _codec(told.value), TaskContext.get().partitionId(), 0
        number: dict = defaultdict()
        number.default_factory = number.__len__
        seq, counts, rest, size = array("I"), [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal seq, counts, rest, size, made
            own = np.frombuffer(seq, np.uint32)
            order = np.argsort(-np.bincount(own, minlength=len(number)), kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            words = pa.array(list(number), pa.string()).take(pa.array(order))
            number.clear()
            offs = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
            data = np.frombuffer(words.buffers()[2], np.uint8) if len(words) and words.buffers()[2] is not None else np.zeros(0, np.uint8)
            where = _dealt(data, offs, buckets)
            lot = f"{task}-{made}-{zlib.crc32(data):08x}"
            order = np.argsort(where, kind="stable")
            cuts = np.append(np.flatnonzero(np.append(True, where[order][1:] != where[order][:-1])[: len(order)]), len(order)).tolist()
            rows = []
            for i, j in zip(cuts[:-1], cuts[1:]):
                x = order[i:j]
                n = offs[x + 1] - offs[x]
                rows.append((int(where[x[0]]), lot, False, _packed(_planes(n, 4), data[ta.ranges(offs[x], n)].tobytes())))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest[0].schema) as w:
                for b in rest:
                    w.write_batch(b)
            own = rank[own]
            seq = array("I")
            body = _packed(*_numbers(own), _planes(where, 2), np.array(counts, np.int32).tobytes(), sink.getvalue().to_pybytes())
            rows.append((zlib.crc32(lot.encode()) % buckets, lot, None, body))
            counts, rest, size, made = [], [], 0, made + 1
            return _rows(rows)

        for batch in batches:
            col, kept, start = batch.column(0), pa.RecordBatch.from_struct_array(batch.column(1)), 0
            for i, t in enumerate(col):
                words = codec.words(t.as_py() or "")
                seq.extend(map(number.__getitem__, words))
                counts.append(len(words))
                size += sum(map(len, words))
                if size > LOT_BYTES or len(number) > LOT_WORDS:
                    rest.append(kept.slice(start, i + 1 - start))
                    start = i + 1
                    yield closed()
            if start < batch.num_rows:
                rest.append(kept.slice(start))
        if rest:
            yield closed()

    return run


def _answers(told, most: int):
    """Each row of words becomes a row with their ids (answer true); word numbers pass. A word is encoded when it first comes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, known = _codec(told.value), {}
        for batch in batches:
            rows = []
            for part, lot, answer, body in zip(*(batch.column(i) for i in range(4))):
                raw, lot = body.as_py(), lot.as_py()
                if not answer.is_valid:
                    rows.append((None, lot, None, raw))
                    continue
                sizes, data = _unpacked(raw)
                offs = np.concatenate([[0], np.cumsum(_from_planes(sizes, 4))]).astype(np.int32)
                words = pa.StringArray.from_buffers(len(offs) - 1, pa.py_buffer(offs.tobytes()), pa.py_buffer(data)).to_pylist()
                if len(known) > most:
                    known = {}
                new = [w for w in words if w not in known]
                known.update(zip(new, [np.array(x, codec.id_kind).tobytes() for x in codec.encode(new)]))
                ids = [known[w] for w in words]
                size, flat = np.fromiter(map(len, ids), np.int64, len(ids)) // codec.id_kind().itemsize, np.frombuffer(b"".join(ids), codec.id_kind)
                rows.append((part.as_py(), lot, True, _packed(_planes(size, 4), _planes(flat, codec.id_kind().itemsize))))
            yield _rows(rows)

    return run


def _joined(told, finish):
    """The rows of a lot become its documents: ids are taken by the number of each word, some texts at a time."""

    def run(table: pa.Table) -> pa.Table:
        codec = _codec(told.value)
        seq, where, counts, rest, answers = None, None, None, None, {}
        for part, answer, body in zip(table["part"].to_pylist(), table["answer"].to_pylist(), table["body"]):
            raw = body.as_py()
            if answer is None:
                one, more, two, three, rest = _unpacked(raw)
                seq, where, counts = _from_numbers(one, more), _from_planes(two, 2), np.frombuffer(three, np.int32).astype(np.int64)
            else:
                answers[part] = raw
        if seq is None or sorted(answers) != np.unique(where).tolist():
            raise RuntimeError("the input gave other rows when a task was run again; store it first")
        size, flat = np.zeros(len(where), np.int64), []
        order, at = np.argsort(where, kind="stable"), 0
        for part in sorted(answers):
            sizes, ids = _unpacked(answers[part])
            sizes = _from_planes(sizes, 4)
            size[order[at : at + len(sizes)]] = sizes
            flat.append(_from_planes(ids, codec.id_kind().itemsize).astype(codec.id_kind))
            at += len(sizes)
        flat = np.concatenate(flat) if flat else np.zeros(0, codec.id_kind)
        first = np.zeros(len(where), np.int64)
        first[order] = np.cumsum(size[order]) - size[order]
        ends, out, lo = np.cumsum(counts), [], 0
        kept = pa.ipc.open_stream(rest).read_all().combine_chunks()
        while lo < len(counts):
            start = ends[lo] - counts[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, start + PART_WORDS, "right")))
            own = seq[start : ends[hi - 1]]
            offs = np.concatenate([[0], np.cumsum(size[own])])[np.concatenate([[0], ends[lo:hi] - start])]
            out.append(finish(codec, kept.slice(lo, hi - lo), flat[ta.ranges(first[own], size[own])], offs))
            lo = hi
        return pa.concat_tables(out)

    return run


def _encoded(docs: DataFrame, tokenizer: str, text: str, rest: list[str], finish, schema, task_words: int = TASK_WORDS, lot_buckets: int | None = None) -> DataFrame:
    """What ``finish`` makes of the columns ``rest`` and the ids of each text."""
    told = docs.sparkSession.sparkContext.broadcast(_spec(tokenizer))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = lot_buckets or min(MAX_BUCKETS, max(1, -(-total // BUCKET_BYTES)))
    lots = docs.select(F.col(text).alias("text"), F.struct(*rest).alias("rest")).mapInArrow(ta.task(_lots(told, buckets)), _KIND)
    answers = lots.repartition(buckets, "part").mapInArrow(ta.task(_answers(told, task_words)), _KIND)
    return answers.groupBy("lot").applyInArrow(ta.group(_joined(told, finish)), schema)


def _decoder(codec: Codec):
    """The function ids (int array) -> text of a task: each id takes its piece."""
    pieces = codec.pieces()

    def text_of(ids: np.ndarray) -> str:
        taken = pieces.take(pa.array(ids))
        offs = np.frombuffer(taken.buffers()[1], np.int32)
        raw = taken.buffers()[2].to_pybytes()[: offs[len(ids)]] if len(ids) and taken.buffers()[2] is not None else b""
        return raw.decode("utf-8", "replace")

    return text_of


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", **bounds) -> DataFrame:
    """``docs`` with the column ``ids`` (array<int>) of each whole text.

    ``tokenizer`` is the path of a tokenizers JSON file on the driver.
    """
    rest = [c for c in docs.columns if c != ids]

    def finish(codec: Codec, kept: pa.Table, flat: np.ndarray, offs: np.ndarray) -> pa.Table:
        return kept.append_column(ids, pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(flat.astype(np.int32))))

    schema = T.StructType([*docs.select(rest).schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return _encoded(docs, tokenizer, text, rest, finish, schema, **bounds)


def decode(docs: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the column ``text`` decoded from ``ids``: each id takes its piece from the vocabulary.

    A null list decodes to the empty text; an id outside the vocabulary, or null, to nothing; bytes that
    are not UTF-8 become U+FFFD.
    """
    told = docs.sparkSession.sparkContext.broadcast(_spec(tokenizer))
    rest = [c for c in docs.columns if c != text]
    at = rest.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(told.value)
        to_text, most = _decoder(codec), codec.most
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                got = []
                for x in part.column(at):
                    i = np.asarray(x.values.drop_null(), np.int64) if x.is_valid else np.zeros(0, np.int64)
                    got.append(to_text(i[(i >= 0) & (i <= most)]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.string())], names=[*rest, text])

    schema = T.StructType([*docs.select(rest).schema.fields, T.StructField(text, T.StringType())])
    return docs.select(rest).mapInArrow(run, schema)


def digest(docs: DataFrame, tokenizer: str, with_ids: bool = False, **bounds) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids of each document."""

    def finish(codec: Codec, kept: pa.Table, flat: np.ndarray, offs: np.ndarray) -> pa.Table:
        taken = codec.pieces().take(pa.array(flat)), codec.numbers().take(pa.array(flat))
        (a, raw), (b, told) = ((np.frombuffer(x.buffers()[1], np.int32)[offs].tolist() if len(flat) else [0] * len(offs), x.buffers()[2]) for x in taken)
        raw, told = (memoryview(x) if x is not None else memoryview(b"") for x in (raw, told))
        decoded = [hashlib.sha256(bytes(raw[i:j]).decode("utf-8", "replace").encode()).hexdigest() for i, j in zip(a[:-1], a[1:])]
        number = [hashlib.sha256(told[i : max(i, j - 1)]).hexdigest() for i, j in zip(b[:-1], b[1:])]  # without the last comma
        out = {"doc_id": kept["doc_id"], "n_tokens": pa.array(np.diff(offs), pa.int64()), "ids_sha256": number, "decoded_sha256": decoded}
        return pa.table(out | ({"ids": pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(flat.astype(np.int32)))} if with_ids else {}))

    kind = f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _encoded(docs, tokenizer, "text", ["doc_id"], finish, kind, **bounds)
