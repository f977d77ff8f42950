"""Operator 5: exact substring deduplication with a run-length index.

A byte is removed if a ``match``-byte string that covers it also starts in a document with a smaller doc_id. Texts
are whole UTF-8 texts, matches never cross documents, and strings are judged on the input.

1. Anchors: in every ``match`` bytes the first least hash of GRAM bytes is the string's anchor, so equal strings have
   equal anchors at equal places. An anchor's context is the union of the strings whose anchor it is.
2. Anchors are dealt by hash into buckets of bounded text, as packed arrays. A task sends an anchor with the same
   context only for its smallest document; the larger ones are repeats already. So a passage that a third of all
   documents share sends one row a task. In a bucket, equal anchors with equal contexts settle likewise.
3. What remains, anchors shared with unequal contexts (the borders of repeated passages), is kept only if another
   context of the anchor has the same half of a string's other bytes on the left or on the right: a string of ``match``
   bytes reaches at least so far on one side. Those go with their context bytes to a run-length index for each
   bucket: a run-compressed Burrows-Wheeler transform with sampled run ends. The contexts stream through it, and
   places whose matching statistics reach ``match`` in a group of suffixes with a smaller document are repeats.
   Bytes are compared here, so hashes that collide do no harm to these.
4. The ranges of each document are joined with its text.

Hot anchors (at the edge of a passage that a third of all documents share, each document has a context of its own)
are found beforehand in one of ``HOT_SAMPLE`` texts, which decides on their way only, never on a result: their strings
of ``match`` bytes are dealt one by one, by their own hash, and of equal strings in a batch one goes on. The list of
hot anchors is bounded by the share ``HOT_SHARE``. Above ``FEW_BUCKETS`` buckets anchors are dealt in two steps, so that
packed bodies don't become small.

Settled repeats (step 2) are equal by 80 bits of two hashes; their bytes aren't compared. Texts travel compressed, by (doc_id, hash of the text).

Defined cases: doc_id is cast to long (a string that is no number is an error under ANSI); a null text is empty; an
empty or short text loses nothing; rows that repeat a doc_id are judged each against smaller doc_ids only; a null
doc_id is neither a source nor shortened; an empty table gives no rows; other columns travel in one private struct,
so no name of theirs can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm import textarrays as ta
from plumbline.llm.runindex import repeated_places

MATCH = 50
GRAM = 16
#: Text of a bucket: it starts small and grows with the corpus, so that buckets stay few, up to a bound.
BUCKET_BYTES = (12 << 20, 256 << 20)
FEW_BUCKETS = 4096
#: Text whose anchors are settled and packed together in a task.
BATCH_BYTES = 16 << 20
#: Text that is hashed at once: its arrays stay in a core's cache.
PIECE_BYTES = 1 << 17
#: Strings that an index takes at once, in bytes (it needs some 200 times that while it is built): a larger bucket is
#: cut by anchor, and the contexts of an anchor that alone are larger by the hash of each string of ``match`` bytes.
INDEX_BYTES = 300_000
#: Text from which contexts are cut at once.
CONTEXT_BYTES = 1 << 20
#: Texts of the sample that finds hot anchors, and the share of its texts (HOT_LEAST at least) that makes an anchor hot.
HOT_SAMPLE = 64
HOT_SHARE = 1 / 2048
HOT_LEAST = 48


def _half(match: int) -> int:
    """Bytes beside an anchor that a string of ``match`` bytes around it has at least on one side."""
    return (match - min(GRAM, match) + 1) // 2


#: In place of an anchor: no string of one text starts here.
_NONE = ta.U64((1 << 64) - 1)


def anchors(data: np.ndarray, offs: np.ndarray, match: int = MATCH) -> tuple[np.ndarray, ...]:
    """(position, row, anchor hash, context hash, halves, extent) of the anchors of a piece.

    halves: 16 bits of the hash of the anchor with the half string on its left, and as many with that on its right;
    zero where the context has no such half. extent: bytes from the context's start to the anchor, times 256, and the
    number of the context's strings less one.
    """
    gram = min(GRAM, match)
    run = match - gram + 1
    if run > 256:
        raise ValueError(f"strings of {255 + GRAM} bytes at most")
    n = len(data) - gram + 1
    windows = n - run + 1  # starts of strings of ``match`` bytes, those across texts included
    if windows < 1:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(ta.U64), z.astype(ta.U64), z.astype(np.uint32), z
    up, down = ta.powers(len(data) + 1)
    acc = np.zeros(len(data) + 1, ta.U64)
    code = data.astype(ta.U64)
    code += ta.U64(1)
    code *= up[: len(data)]
    np.cumsum(code, out=acc[1:])
    # the upper half of a hash orders the grams, with the place below it: of equal ones the first is least
    least = np.subtract(acc[gram:], acc[:-gram], out=code[:n])
    least *= down[:n]
    least &= ta.U64(0xFFFFFFFF00000000)
    least |= np.arange(n, dtype=ta.U64)
    least = ta.sliding(least, run, np.minimum)
    # strings across texts have no anchor; between those of two texts there are always some
    stops = np.minimum(offs[1:], windows)
    across = np.maximum(offs[1:] - match + 1, offs[:-1])
    least[ta.ranges(across, np.maximum(stops - across, 0))] = _NONE
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    last = np.append(first[1:], windows) - 1
    some = np.flatnonzero(least[first] != _NONE)
    start, stop = first[some], last[some] + match
    at = (least[start] & ta.U64(0xFFFFFFFF)).astype(np.int64)
    h = ta.mix((acc[at + gram] - acc[at]) * down[at])
    r = np.searchsorted(offs, start, "right") - 1
    extent = (at - start) << 8 | (stop - match - start)
    context = ta.mix((acc[stop] - acc[start]) * down[start] + extent.astype(ta.U64) * ta.U64(0xD6E8FEB86659FD93))
    halves, half = np.zeros(len(at), np.uint32), _half(match)
    for shift, a, b in ((0, at - half, at + gram), (16, at, at + gram + half)):
        ok = np.flatnonzero((a >= start) & (b <= stop))
        x = ta.mix((acc[b[ok]] - acc[a[ok]]) * down[a[ok]]) % ta.U64(65535) + ta.U64(1)
        halves[ok] |= x.astype(np.uint32) << np.uint32(shift)
    return at - offs[r], r, h, context, halves, extent


_FIELDS = (("h", np.uint32), ("c1", np.uint32), ("c2", np.uint16), ("d", np.uint16), ("p1", np.uint16), ("p2", np.uint16), ("e", np.uint16), ("s", np.uint32))
#: What a packed body holds: repeats that are settled, anchors that must meet, and hot anchors.
SETTLED, OPEN, HOT = 0, 1, 2


def _pack(ids: np.ndarray, text: np.ndarray, row: np.ndarray, h, c, pos, s, e, kind: int) -> bytes:
    """Columns one after the other, which compress better than rows; doc_ids once in a table. Only open anchors need hashes.

    ``row`` is each anchor's place in ``ids`` and ``text``.
    """
    place = np.zeros(len(ids), np.uint16)
    place[row] = 1
    key = np.flatnonzero(place)
    place[key] = np.arange(len(key))
    zero = np.zeros(len(pos) if kind != OPEN else 0, np.uint32)
    d = place[row]
    cols = (h >> ta.U64(32), c, c >> ta.U64(32), d, pos, pos >> 16, e, s) if kind == OPEN else (zero, zero, zero, d, pos, pos >> 16, e, zero)
    head = np.array([len(key), len(h)], np.int64)
    return b"".join([head.tobytes(), ids[key].astype(np.int64).tobytes(), text[key].astype(np.int32).tobytes(), *[x.astype(t).tobytes() for x, (_, t) in zip(cols, _FIELDS)]])


def _unpack(raw: bytes) -> tuple[np.ndarray, ...]:
    docs, n = np.frombuffer(raw, np.int64, 2)
    at = 16
    ids = np.frombuffer(raw, np.int64, docs, at)
    th = np.frombuffer(raw, np.int32, docs, at := at + 8 * docs)
    at += 4 * docs
    got = {}
    for name, kind in _FIELDS:
        got[name] = np.frombuffer(raw, kind, n, at)
        at += n * np.dtype(kind).itemsize
    return ids[got["d"]], th[got["d"]], got["h"], got["c1"].astype(np.int64) | got["c2"].astype(np.int64) << 32, got["p1"].astype(np.int64) | got["p2"].astype(np.int64) << 16, got["s"], got["e"]


def _smaller_twin(h, c, doc) -> np.ndarray:
    """True where another row has the same anchor and context and a smaller doc_id.

    Rows are sorted by one hash of both; where two pairs share it some twins are not told here, and meet in their bucket.
    """
    order = np.argsort(h ^ (c * ta.U64(0x9E3779B97F4A7C15)))
    hs, cs, ds = h[order], c[order], doc[order]
    first = np.flatnonzero(np.append(True, (hs[1:] != hs[:-1]) | (cs[1:] != cs[:-1]))[: len(h)])
    out = np.zeros(len(h), bool)
    if len(h):
        out[order] = ds > np.repeat(np.minimum.reduceat(ds, first), np.diff(np.append(first, len(h))))
    return out


def _dealt(where: np.ndarray, kind: int, ids, th, row, h, c, pos, s, e) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, kind, body) of anchors by the bucket ``where``; ``row`` is each anchor's place in ``ids`` and ``th``."""
    # by bucket and, as that compresses better, nearly by hash
    order = np.argsort(where.astype(ta.U64) << ta.U64(40) | h >> ta.U64(24))
    where = where[order]
    cuts = np.append(np.flatnonzero(np.append(True, where[1:] != where[:-1])[: len(order)]), len(order))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        for lo in range(i, j, 1 << 16):  # a document's place in a body takes 16 bits
            y = order[lo : min(lo + (1 << 16), j)]
            yield int(where[lo]), kind, _pack(ids, th, row[y], h[y], c[y], pos[y], s[y], e[y], kind)


def _bodies(rows) -> pa.RecordBatch:
    out: list = [[], [], []]
    for row in rows:
        for col, v in zip(out, row):
            col.append(v)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int8()), pa.array(out[2], pa.binary())], names=["bucket", "kind", "body"])


def _anchor_rows(buckets: int, match: int, hot):
    """(bucket, kind, body): packed anchors of each batch; settled and hot ones need no meeting and go anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, th = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            got, size = [], 0
            for lo, hi, data, offs in ta.pieces(batch, "text", PIECE_BYTES):
                pos, r, h, c, s, e = anchors(data, offs, match)
                got.append((lo + r, h, c, pos, s, e))
                size += len(data)
                if size < BATCH_BYTES and hi < batch.num_rows:
                    continue
                yield _bodies(packed(ids, th, *(np.concatenate(x) for x in zip(*got))))
                got, size = [], 0

    def packed(ids, th, r, h, c, pos, s, e):
        done, often = _smaller_twin(h, c, ids[r]), np.isin(h, hot.value)
        for some, kind in ((np.flatnonzero(done), SETTLED), (np.flatnonzero(~done & often), HOT), (np.flatnonzero(~done & ~often), OPEN)):
            if len(some):
                where = ids[r[some]] % buckets if kind != OPEN else (h[some] % ta.U64(buckets)).astype(np.int64)
                yield from _dealt(where, kind, ids, th, r[some], h[some], c[some], pos[some], s[some], e[some])

    return run


def _hot_anchors(known: DataFrame, match: int, sample: int = HOT_SAMPLE, share: float = HOT_SHARE, least: int = HOT_LEAST) -> np.ndarray:
    """Hashes, ascending, of the anchors that very many texts of a sample have, with contexts of their own each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _lo, _hi, data, offs in ta.pieces(batch, "text", PIECE_BYTES):
                _, _, h, c, _, _ = anchors(data, offs, match)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64))], names=["h", "c"])

    some = known.where(F.pmod(F.xxhash64("doc_id", "th"), F.lit(sample)) == 0)
    n = some.count()
    if n < least:
        return np.zeros(0, ta.U64)
    often = some.mapInArrow(ta.task(run), "h long, c long").distinct().groupBy("h").count().where(F.col("count") >= max(least, n * share))
    return np.sort(often.select("h").toArrow()["h"].to_numpy().view(ta.U64))


def _coarse(buckets: int) -> int:
    return int(np.ceil(np.sqrt(buckets)))


def _dealt_again(first: int, buckets: int):
    """Bodies dealt by ``bucket % first`` become bodies by bucket; a task holds BATCH_BYTES of them at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for where, kind, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if kind != OPEN:
                    yield _bodies([(where, kind, body)])
                    continue
                held.append((where, _unpack(body)))
                size += len(body)
                if size > BATCH_BYTES:
                    yield _bodies(again(held))
                    held, size = [], 0
        if held:
            yield _bodies(again(held))

    def again(held):
        doc, th, h, c, pos, s, e = (np.concatenate(x) for x in zip(*(x for _, x in held)))
        where = np.repeat([w for w, _ in held], [len(x[0]) for _, x in held])
        key, row = np.unique(np.rec.fromarrays([doc, th]), return_inverse=True)
        # the upper half of the hash is what travels; it tells the bucket within the coarse one
        yield from _dealt(where + first * (h.astype(np.int64) % -(-buckets // first)), OPEN, key.f0, key.f1, row, h.astype(ta.U64) << ta.U64(32), c.astype(ta.U64), pos, s, e)

    return run


def _several(h: np.ndarray, side: np.ndarray, c: np.ndarray) -> np.ndarray:
    """True for anchors of whose rows with the same half (not zero) some have another context."""
    key = h.astype(ta.U64) << ta.U64(16) | side.astype(ta.U64)
    order = np.argsort(key)
    key, cs = key[order], c[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(h)])
    out = np.zeros(len(h), bool)
    if len(h):
        out[order] = np.repeat(np.minimum.reduceat(cs, start) < np.maximum.reduceat(cs, start), np.diff(np.append(start, len(h))))
    return out & (side != 0)


def _by_context(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The order of rows by (h, c), of 32 and 48 bits."""
    key = h.astype(ta.U64) << ta.U64(32) | c.astype(ta.U64) >> ta.U64(16)
    order = np.argsort(key)
    k, cs = key[order], c[order]
    # 64 bits tell almost all apart, and sorting one column is much faster
    return np.lexsort((c, h)) if ((k[1:] == k[:-1]) & (cs[1:] != cs[:-1])).any() else order


def _settle(table: pa.Table) -> pa.Table:
    """(doc_id, th, code) of a bucket's shared anchors: code is the position, the extent (16 bits) and what is to be done (2 bits)."""
    got = []
    open_parts = []
    for body, kind in zip(table["body"], table["kind"].to_pylist()):
        doc, th, h, c, pos, s, e = _unpack(body.as_py())
        code = pos << 18 | e.astype(np.int64) << 2
        if kind == OPEN:
            open_parts.append((doc, th, h, c, code, s))
        else:
            got.append((doc, th, code | kind))
    if open_parts:
        doc, th, h, c, code, s = (np.concatenate(x) for x in zip(*open_parts))
        del open_parts
        order = _by_context(h, c)
        doc, th, h, c, code, s = doc[order], th[order], h[order], c[order], code[order], s[order]
        new_h = np.append(True, h[1:] != h[:-1])
        new_c = new_h | np.append(True, c[1:] != c[:-1])
        first = np.flatnonzero(new_c)
        later = doc > np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(h))))
        got.append((doc[later], th[later], code[later]))
        start = np.flatnonzero(new_h)
        contexts = np.add.reduceat(new_c.astype(np.int64), start)
        border = np.flatnonzero(np.repeat(contexts > 1, np.diff(np.append(start, len(h)))) & ~later)
        hb, cb, sb = h[border], c[border], s[border]
        border = border[_several(hb, sb & np.uint32(0xFFFF), cb) | _several(hb, sb >> np.uint32(16), cb)]
        got.append((doc[border], th[border], code[border] | OPEN))
    doc, th, code = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))
    return pa.table({"doc_id": pa.array(doc, pa.int64()), "th": pa.array(th, pa.int32()), "code": pa.array(code, pa.int64())})


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges, as ascending ranges that don't touch."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > end[:-1])
    return start[new], end[np.append(new[1:], True)]


def _text(z, size: int) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(z.as_py(), size), np.uint8) if size else np.zeros(0, np.uint8)


def _context_rows(buckets: int, match: int):
    """(bucket, doc_id, th, start, stop, body): contexts to compare, with stop a hash of the anchor and its place in the context; body null: a settled range.

    A hot anchor gives its strings of ``match`` bytes instead; of equal ones in a batch those of larger documents are settled.
    """
    gram = min(GRAM, match)
    up, _ = ta.powers(gram + 1)
    up = up[:gram].copy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(3).to_numpy()
            lot = np.cumsum(n) // CONTEXT_BYTES
            cuts = np.append(np.flatnonzero(np.append(True, lot[1:] != lot[:-1])[: len(n)]), len(n)).tolist()
            for i, j in zip(cuts[:-1], cuts[1:]):
                yield pa.RecordBatch.from_arrays(of(batch.slice(i, j - i)), names=["bucket", "doc_id", "th", "start", "stop", "body"])

    def of(batch: pa.RecordBatch) -> list[pa.Array]:
        some = batch.filter(batch.column(4).is_valid())
        ids, ths, n = (some.column(i).to_numpy() for i in (0, 1, 3))
        base = np.concatenate([[0], np.cumsum(n + 1)])  # a text's place among all, with a byte between two
        codes = some.column(4)
        code, row = codes.flatten().to_numpy(), np.repeat(np.arange(len(ids)), codes.value_lengths().to_numpy())
        order = np.lexsort((code, row))
        code, row = code[order], row[order]
        new = np.append(True, (code[1:] != code[:-1]) | (row[1:] != row[:-1]))[: len(code)]
        code, row = code[new], row[new]
        kind, place, more = code & 3, code >> 10 & 255, code >> 2 & 255
        pos = (code >> 18) + base[row]
        start = pos - place
        stop = start + more + match
        a, b = _merged(start[kind == SETTLED], stop[kind == SETTLED])
        r = np.searchsorted(base, a, "right") - 1
        got = [(ids[r] % buckets, r, a, b - base[r], np.zeros(len(a), np.int64))]
        border, often = np.flatnonzero(kind == OPEN), np.flatnonzero(kind == HOT)
        data = np.zeros(base[-1], np.uint8)
        for i in np.unique(row[kind != SETTLED]).tolist():
            data[base[i] : base[i + 1] - 1] = _text(some.column(2)[i], int(n[i]))
        if len(border):
            view = np.lib.stride_tricks.sliding_window_view(data, gram)[pos[border]].astype(ta.U64) + ta.U64(1)
            h = (ta.mix((view * up).sum(axis=1)) >> ta.U64(20)).astype(np.int64)
            got.append((h % buckets, row[border], start[border], h // buckets << 16 | place[border], stop[border] - start[border]))
        if len(often):
            at = np.unique(ta.ranges(start[often], more[often] + 1))
            r = np.searchsorted(base, at, "right") - 1
            raw, least = data.tobytes(), {}
            strings = [raw[x : x + match] for x in at.tolist()]
            for x, d in zip(strings, ids[r].tolist()):
                least[x] = min(d, least.get(x, d))
            settled = ids[r] > np.array([least[x] for x in strings], np.int64)
            h = np.array([zlib.crc32(x) for x in strings], np.int64)
            got.append((h % buckets, r, at, np.where(settled, at - base[r] + match, h // buckets << 16), np.where(settled, 0, match)))
        bucket, row, at, stop, size = (np.concatenate(x) for x in zip(*got))
        offs = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        full = pa.array(size > 0).buffers()[1]
        body = pa.Array.from_buffers(pa.binary(), len(size), [full, pa.py_buffer(offs), pa.py_buffer(data[ta.ranges(at, size)])])
        return [pa.array(bucket, pa.int64()), pa.array(ids[row], pa.int64()), pa.array(ths[row], pa.int32()), pa.array(at - base[row], pa.int64()), pa.array(stop, pa.int64()), body]

    return run


def _promising(body: pa.BinaryArray, where: np.ndarray, match: int) -> np.ndarray:
    """The contexts that share their anchor with half of a string's other bytes, on the left or on the right.

    A string of ``match`` bytes around an anchor reaches at least so far on one side, so the others have no equal.
    """
    gram = min(GRAM, match)
    half = _half(match)
    wide = gram + half
    offs = np.frombuffer(body.buffers()[1], np.int32)[body.offset : body.offset + len(body) + 1].astype(np.int64)
    raw = np.frombuffer(body.buffers()[2], np.uint8)
    place = where & 0xFFFF
    keep = np.zeros(len(body), bool)
    for start in (offs[:-1] + place - half, offs[:-1] + place):
        able = np.flatnonzero((start >= offs[:-1]) & (start + wide <= offs[1:]))
        key = np.zeros(len(able), ta.U64)
        for lo in range(0, len(able), 1 << 14):
            some = start[able[lo : lo + (1 << 14)]]
            part = np.zeros((len(some), -(-wide // 8) * 8), np.uint8)
            part[:, :wide] = np.lib.stride_tricks.sliding_window_view(raw, wide)[some]
            for word in part.view(ta.U64).T:
                key[lo : lo + len(some)] = ta.mix(key[lo : lo + len(some)] * ta.U64(3) + word)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        keep[able[order[1:][same]]] = True
        keep[able[order[:-1][same]]] = True
    return np.flatnonzero(keep)


def _places(strings: list[bytes], owner: np.ndarray, anchor: np.ndarray, match: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(string, offset) of repeated places, by run-length indexes of at most about ``most`` bytes each."""
    size = np.array([len(x) for x in strings])
    by = np.argsort(anchor, kind="stable")  # equal anchors stay together
    new = np.append(True, anchor[by][1:] != anchor[by][:-1])
    group = np.cumsum(new) - 1
    total = np.bincount(group, size[by])
    lot = np.cumsum(total) // most
    for x in np.unique(lot):
        own = by[lot[group] == x]
        if size[own].sum() <= 2 * most or not size[own].any():
            i, t = repeated_places([strings[j] for j in own], owner[own], match)
            yield own[i], t
            continue
        # one anchor with very many contexts: equal strings of ``match`` bytes meet by their hash instead
        at = [(j, t) for j in own.tolist() for t in range(len(strings[j]) - match + 1)]
        parts = -(-len(at) * match // most)
        part = np.array([zlib.crc32(strings[j][t : t + match]) % parts for j, t in at])
        for k in range(parts):
            some = [at[m] for m in np.flatnonzero(part == k).tolist()]
            i, _ = repeated_places([strings[j][t : t + match] for j, t in some], np.array([owner[j] for j, _ in some], np.int64), match)
            yield np.array([some[m][0] for m in i.tolist()], np.int64), np.array([some[m][1] for m in i.tolist()], np.int64)


def _index(match: int, most: int):
    """Ranges (doc_id, th, start, stop) that repeat, from the contexts of a bucket."""

    def run(table: pa.Table) -> pa.Table:
        body = table["body"].combine_chunks()
        body = body.chunk(0) if isinstance(body, pa.ChunkedArray) else body
        null = np.asarray(body.is_null())
        doc, th = table["doc_id"].to_numpy(), table["th"].to_numpy()
        start, stop = table["start"].to_numpy(), table["stop"].to_numpy()
        got = [(doc[null], th[null], start[null], stop[null])]
        rest = np.flatnonzero(~null)
        if len(rest):
            rest = rest[_promising(body.take(pa.array(rest)), stop[rest], match)]
            strings = body.take(pa.array(rest)).to_pylist()
            for i, t in _places(strings, doc[rest], stop[rest] >> 16, match, most) if len(rest) else ():
                if len(i):
                    order = np.lexsort((t, i))
                    i, t = i[order], t[order]
                    new = np.append(True, (i[1:] != i[:-1]) | (t[1:] > t[:-1] + match))
                    j = rest[i[new]]
                    got.append((doc[j], th[j], start[j] + t[new], start[j] + t[np.append(new[1:], True)] + match))
        doc, th, a, b = (np.concatenate(x) for x in zip(*got))
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "th": pa.array(th, pa.int32()), "start": pa.array(a, pa.int64()), "stop": pa.array(b, pa.int64())})

    return run


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd", compression_level=3)
    for batch in batches:
        z, size = [], []
        for _lo, _hi, data, offs in ta.pieces(batch, "text"):
            raw = data.tobytes()
            z += [codec.compress(raw[a:b], asbytes=True) if b > a else b"" for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            size += np.diff(offs).tolist()
        yield pa.RecordBatch.from_arrays([*batch.columns[1:3], pa.array(z, pa.binary()), pa.array(size, pa.int64()), *batch.columns[3:]], names=["doc_id", "th", "z", "n", *batch.schema.names[3:]])


def _base(docs: DataFrame) -> tuple[Column, Column, Column]:
    """The text (null: empty), the doc_id as long and a hash of the text that tells rows of one doc_id apart."""
    text = F.coalesce("text", F.lit(""))
    return text.alias("text"), F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("th")


def packed_texts(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, th, z, n, rest): texts compressed, their bytes, and the columns ``keep`` in a struct, where given."""
    rest = [F.struct(*keep).alias("rest")] if keep else []
    base = docs.select(*_base(docs), *rest)
    kind = T.StructType.fromDDL("doc_id long, th int, z binary, n long")
    return base.mapInArrow(ta.task(_compressed), T.StructType([*kind.fields, *base.schema.fields[3:]]))


def _finished(as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list = [[] for _ in range(3)]
            for z, n, spans in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3)):
                if spans.is_valid and len(spans):
                    a, b = _merged(spans.values.field(0).to_numpy(), spans.values.field(1).to_numpy())
                else:
                    a = b = np.zeros(0, np.int64)
                raw = _text(z, n).tobytes()
                cut = [0, *np.stack([a, b], axis=1).ravel().tolist(), n]
                out[0].append([{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist())])
                out[1].append(int((b - a).sum()))
                left = b"".join([raw[x:y] for x, y in zip(cut[::2], cut[1::2])])
                out[2].append(left.decode("utf-8", "ignore") if as_text else left)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            cols = [batch.column(0), batch.column(2), pa.array(out[1], pa.int64()), pa.array(out[0], kind), pa.array(out[2], pa.string() if as_text else pa.binary())]
            yield pa.RecordBatch.from_arrays([*cols, *batch.columns[4:]], names=["doc_id", "n_bytes", "n_removed", "spans", "kept", *batch.schema.names[4:]])

    return run


def _deduped(docs: DataFrame, match: int, keep: list[str], as_text: bool, few: int = FEW_BUCKETS, index: int = INDEX_BYTES, hot: tuple = (HOT_SAMPLE, HOT_SHARE, HOT_LEAST)) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans, kept and, where ``keep`` names columns, a struct ``rest`` of them."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least, most = BUCKET_BYTES
    buckets = max(1, -(-total // min(most, max(least, total // FEW_BUCKETS))))
    known = docs.select(*_base(docs)).where("doc_id IS NOT NULL")
    often = spark.sparkContext.broadcast(_hot_anchors(known, match, *hot))
    kind = "bucket long, kind byte, body binary"
    if buckets <= few:
        packed = known.mapInArrow(ta.task(_anchor_rows(buckets, match, often)), kind)
    else:
        first = _coarse(buckets)
        packed = known.mapInArrow(_anchor_rows(first, match, often), kind).repartition(first, "bucket").mapInArrow(_dealt_again(first, buckets), kind)
    shared = packed.groupBy("bucket").applyInArrow(ta.group(_settle), "doc_id long, th int, code long")
    shared = shared.groupBy("doc_id", "th").agg(F.collect_list("code").alias("codes"))
    texts = packed_texts(docs, keep)
    rest = ["rest"] if keep else []
    # outer and with the struct, so that both joins with the texts read one shuffle of them
    contexts = texts.join(shared, ["doc_id", "th"], "left").select("doc_id", "th", "z", "n", "codes", *rest).mapInArrow(ta.task(_context_rows(buckets, match)), "bucket long, doc_id long, th int, start long, stop long, body binary")
    spans = contexts.groupBy("bucket").applyInArrow(ta.group(_index(match, index)), "doc_id long, th int, start long, stop long")
    spans = spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    schema = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept " + ("string" if as_text else "binary"))
    schema = T.StructType([*schema.fields, *texts.schema.fields[4:]])
    return texts.join(spans, ["doc_id", "th"], "left").select("doc_id", "z", "n", "spans", *rest).mapInArrow(ta.task(_finished(as_text)), schema)


def dedup(docs: DataFrame, match: int = MATCH, keep: list[str] | None = None, as_text: bool = False, **ways) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed byte ranges [start, stop), maximal), kept (binary) of each row.

    ``keep`` names columns of ``docs`` to return as well (those with an output's name are replaced by it); ``as_text``
    returns kept as a string of its whole characters. ``ways`` (few, index, hot) change bounds, never results.
    """
    out = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    keep = [c for c in keep or [] if c not in out]
    return _deduped(docs, match, keep, as_text, **ways).select(*out, *[F.col("rest").getField(c).alias(c) for c in keep])


def shortened(docs: DataFrame, match: int = MATCH) -> DataFrame:
    """``docs`` (with doc_id, text and any other columns) with the repeats cut out of text; n_chars, if there, is counted anew.

    A character that is cut in the middle loses its other bytes too. Rows stay, if need be with an empty text.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    got = _deduped(docs, match, rest, True)
    value = {c: F.col("rest").getField(c) for c in rest} | {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.char_length("kept")}
    return got.select([value[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def op5(spark, sf_dir: str, **ways) -> DataFrame:
    got = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), **ways)
    return got.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
