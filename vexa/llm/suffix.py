"""Removal of repeated passages with a Burrows-Wheeler transform (operator 9).

A byte goes if a string of ``length`` bytes that covers it also starts earlier.

1. Every window of ``length`` bytes is assigned to an anchor, the smallest
   hash among its ``gram``-byte substrings.  Equal windows choose the
   same anchor, so windows whose anchor occurs once are finished.  Consecutive
   windows with one anchor form a segment.
2. A segment whose bytes are equal to those of an earlier segment is repeated as
   a whole; only the first of equal segments goes on, and only if its anchor
   has other segments.
3. The segments of one anchor go to one block of bounded bytes (or, by a hash, to
   several).  ``repeat_classes`` sorts a block's suffixes to the needed depth, takes the
   transform, and derives common prefixes by increasing value: intervals of
   equal strings are extended backwards, breadth first, by one byte per level; the
   boundaries an extension reaches first have that level as common prefix.  Extension stops
   at ``length``: boundaries not reached separate suffixes that agree on ``length`` bytes.
4. The first windows of classes of anchors that fill several blocks are matched between
   blocks on 128-bit hashes.
5. Spans are united per document.

Bytes are those of the UTF-8 text (null: empty) and matches never cross documents.
Texts shorter than ``length`` lose nothing.  "Earlier" is document order
(see ``common.identified`` for repeated and null ids), then position.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexa.llm import common as C

GRAM = 20
STEP = 1 << 20       # window starts handled at once
BLOCK = 3 << 19      # bytes per transform
_BITS = 21           # a block has fewer than 2**21 positions


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of ``w`` values, from those of windows of doubled width."""
    have = 1
    while 2 * have <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (w - have)], x[w - have:]) if have < w else x


def segments(data: np.ndarray, offs: np.ndarray, length: int, gram: int = GRAM):
    """(text, start, bytes, anchor hash, content hash) of every segment."""
    gram = min(gram, length)
    out = []
    owner = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))
    room = offs[1:] - length  # last window start of each text
    for lo in range(0, max(len(data) - length + 1, 0), STEP):
        piece = data[lo:lo + STEP + length - 1]
        m = len(piece) - length + 1
        roll = C.RollingHash(piece)
        h = roll.windows(gram)
        keys = (h & ~np.uint64((1 << _BITS) - 1)) | np.arange(len(h), dtype=np.uint64)
        at = (_sliding_min(keys, length - gram + 1)[:m] & np.uint64((1 << _BITS) - 1)).astype(np.int64)
        text = owner[lo:lo + m]
        ok = np.arange(lo, lo + m) <= room[text]
        new = np.ones(m, bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~ok[:-1]
        first = np.flatnonzero(new & ok)
        if not len(first):
            continue
        # a segment ends at the last valid window before the next start
        stop = np.append(np.flatnonzero(new | ~ok), m)
        last = stop[np.searchsorted(stop, first, side="right")]
        size = last - first + length - 1
        who = text[first].astype(np.int64)
        out.append((who, first + lo - offs[who], size, h[at[first]], roll.ranges(first, first + size)))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def _ranked_suffixes(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations of ``codes`` sorted by at least their first ``depth`` values."""
    n = len(codes)
    bits = max(1, int(codes.max()).bit_length())
    h = max(1, 42 // bits)
    wrap = np.concatenate([codes, np.resize(codes, h)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(h):
        key = (key << np.uint64(bits)) | wrap[j:j + n]
    index = np.arange(n, dtype=np.uint64)
    low = np.uint64((1 << _BITS) - 1)
    key = np.sort((key << np.uint64(_BITS)) | index)
    sa = (key & low).astype(np.int64)
    head = np.ones(n, bool)
    head[1:] = (key[1:] >> np.uint64(_BITS)) != (key[:-1] >> np.uint64(_BITS))
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    while h < depth:
        # only suffixes that share a rank are sorted again
        tied = ~head | np.append(~head[1:], False)
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        who = sa[slots]
        nxt = who + h
        nxt[nxt >= n] %= n
        key = ((rank[who].astype(np.uint64) << np.uint64(2 * _BITS)) | (rank[nxt].astype(np.uint64) << np.uint64(_BITS))
               | who.astype(np.uint64))
        key.sort()
        who = (key & low).astype(np.int64)
        sa[slots] = who
        same = np.zeros(len(slots), bool)
        same[1:] = (key[1:] >> np.uint64(_BITS)) == (key[:-1] >> np.uint64(_BITS))
        head[slots] = ~same
        rank[who] = np.maximum.accumulate(np.where(same, 0, slots))
        h *= 2
    return sa, rank


def repeat_classes(codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, class of each): rotations in one class agree on ``length`` values.

    Interval expansion on the transform: level by level, each interval of
    suffixes that start with a string w is split by the preceding value c into the
    intervals of cw.  The end of an interval reached for the first time at level l has the
    common prefix l.
    """
    n = len(codes)
    sa, _ = _ranked_suffixes(codes, length)
    bwt = codes[sa - 1]
    order = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[order] = np.arange(n) << _BITS
    front = bwt[order] << _BITS
    known = np.zeros(n + 1, bool)  # boundaries whose common prefix is below the level
    known[0] = known[n] = True
    lb, rb = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(length):
        if not len(lb):
            break
        width = rb - lb
        total = int(width.sum())
        owner = np.repeat(np.arange(len(lb), dtype=np.int64), width)
        idx = np.arange(total) + np.repeat(lb - np.cumsum(width) + width, width)
        packed = np.sort(lf[idx] | owner)  # extensions lie side by side, in order
        f = packed >> _BITS
        packed &= (1 << _BITS) - 1
        head = np.ones(total, bool)
        packed |= front[f]
        head[1:] = packed[1:] != packed[:-1]
        at = np.flatnonzero(head)
        lo, hi = f[at], f[np.append(at[1:], total) - 1] + 1
        fresh = ~known[hi]
        lb, rb = lo[fresh], hi[fresh]
        known[rb] = True
    return sa, np.cumsum(known[:n]) - 1


def repeated_windows(parts: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For byte strings in document order: (part, offset, first) of every window of
    ``length`` bytes that has an equal one, first marking the earliest of its class;
    windows without an equal one are left out."""
    size = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    text = np.zeros(int(size.sum()) + len(parts), np.int64)
    used = np.zeros(256, bool)
    raw = np.concatenate(parts)
    used[raw] = True
    code = np.cumsum(used)  # 1.. for the bytes that occur; 0 separates the parts
    at = np.arange(len(raw)) + np.repeat(np.arange(len(parts)), size)
    text[at] = code[raw]
    sa, cls = repeat_classes(text, length)
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), size + 1)
    starts = np.arange(len(text)) <= (begin + size - length)[owner]
    keep = starts[sa]
    sa, cls = sa[keep], cls[keep]
    part = owner[sa].astype(np.int64)
    if not len(sa):
        return sa, sa, np.zeros(0, bool)
    head = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
    count = np.diff(np.append(head, len(cls)))
    first = np.repeat(np.minimum.reduceat(sa, head), count) == sa
    many = np.repeat(count, count) > 1
    return part[many], (sa - begin[part])[many], first[many]


def _runs(text: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the union of windows."""
    o = np.lexsort((start, text))
    text, start = text[o], start[o]
    new = np.ones(len(start), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] > start[:-1] + length)
    at = np.flatnonzero(new)
    return text[at], start[at], start[np.append(at[1:], len(start)) - 1] + length


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, content, _uid, place): place packs a segment's start and size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in C.text_blocks(batches):
            text, start, size, anchor, content = segments(data, offs, length)
            uid = C.longs(rows, "_uid")[text]
            for i in range(0, len(uid), 1 << 17):
                s = slice(i, i + (1 << 17))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[s].view(np.int64)), pa.array(content[s].view(np.int64)), pa.array(uid[s]),
                     pa.array((start[s] << 16) | size[s])], ["anchor", "content", "_uid", "place"])

    return docs.select(C.UID, "text").mapInArrow(run, "anchor long, content long, _uid long, place long")


def packed_texts(docs: DataFrame) -> DataFrame:
    """(_uid, z): texts compressed for the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for rows, data, offs in C.text_blocks(batches):
            raw = data.tobytes()
            z = [zip_.compress(raw[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(z, pa.binary())], ["_uid", "z"])

    return docs.select(C.UID, "text").mapInArrow(run, "_uid long, z binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, bytes]]:
    unzip = zstandard.ZstdDecompressor()
    for b in batches:
        z = b.column(b.schema.get_field_index("z"))
        for i in range(b.num_rows):
            yield b, i, unzip.decompress(z[i].as_buffer()) if z[i].is_valid else b""


def _indexed_segments(docs: DataFrame, first: DataFrame, length: int) -> DataFrame:
    """(anchor, salt, salts, _uid, start, bytes) of the segments to be transformed."""
    wanted = first.groupBy("_uid").agg(F.collect_list(F.struct("anchor", "salts", "place")).alias("s"))  # within one text
    schema = "anchor long, salt int, salts int, _uid long, start long, bytes binary"

    def table(held: list) -> pa.RecordBatch:
        uid, anchor, salts, place = (np.concatenate([h[k] for h in held]) for k in range(4))
        key = C.mix(place.view(np.uint64) ^ C.mix(uid.view(np.uint64)))
        blobs = [x for h in held for x in h[4]]
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array((key % salts.astype(np.uint64)).astype(np.int32)), pa.array(salts.astype(np.int32)),
             pa.array(uid), pa.array(place >> 16), pa.array(blobs, pa.binary())],
            ["anchor", "salt", "salts", "_uid", "start", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b, i, raw in _unpacked(batches):
            s = b.column(b.schema.get_field_index("s"))[i].values
            uid = b.column(b.schema.get_field_index("_uid"))[i].as_py()
            anchor, salts, place = (s.field(n).to_numpy(zero_copy_only=False).astype(np.int64)
                                    for n in ("anchor", "salts", "place"))
            start, stop = place >> 16, (place >> 16) + (place & 0xFFFF)
            held.append((np.full(len(place), uid, np.int64), anchor, salts, place,
                         [raw[a:z] for a, z in zip(start.tolist(), stop.tolist())]))
            size += len(place)
            if size > 1 << 14:
                yield table(held)
                held, size = [], 0
        if held:
            yield table(held)

    return packed_texts(docs).join(wanted, "_uid").mapInArrow(run, schema)


def _transformed(segs: DataFrame, length: int, block: int) -> DataFrame:
    """(_uid, start, stop, bucket, firsts): spans repeated within a block, and, packed by hash
    bucket, (hash, hash, _uid, start) of the first windows of the classes of anchors that lie in
    several blocks."""
    buckets = C.shuffle_partitions(segs.sparkSession)
    names = ["_uid", "start", "stop", "bucket", "firsts"]

    def solve(tables: list[pa.Table]):
        t = pa.concat_tables(tables)
        t = t.take(pa.array(np.lexsort((C.longs(t, "start"), C.longs(t, "_uid")))))  # document order
        blob, offs = C.column_bytes(t.column("bytes").combine_chunks())
        parts = [blob[a:b] for a, b in zip(offs[:-1], offs[1:])]
        uid, start = C.longs(t, "_uid"), C.longs(t, "start")
        spread = C.longs(t, "salts") > 1
        part, off, first = repeated_windows(parts, length)
        later = ~first
        # windows of a document may lie in several segments: unite them here by segment
        who, a, b = _runs(part[later], off[later], length) if later.any() else (part[:0],) * 3
        if len(who):
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid[who]), pa.array(start[who] + a), pa.array(start[who] + b), pa.nulls(len(who), pa.int32()),
                 pa.nulls(len(who), pa.binary())], names)
        if spread.any():
            size = np.diff(offs)
            n = np.where(spread, np.maximum(size - length + 1, 0), 0)
            p = np.repeat(np.arange(len(parts)), n)
            o = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = offs[p] + o
            skip = np.zeros(len(blob) + 1, bool)
            skip[offs[part[later]] + off[later]] = True
            p, o, at = p[~skip[at]], o[~skip[at]], at[~skip[at]]
            d1 = C.RollingHash(blob).ranges(at, at + length)
            d2 = C.RollingHash(255 - blob[::-1]).ranges(len(blob) - at - length, len(blob) - at)
            where = (d1 % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(where, kind="stable")
            cut = np.searchsorted(where[by], np.arange(buckets + 1))
            rows = np.stack([d1.view(np.int64), d2.view(np.int64), uid[p], start[p] + o], 1)[by]
            some = np.flatnonzero(np.diff(cut))
            empty = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [empty, empty, empty, pa.array(some.astype(np.int32)),
                 pa.array([rows[cut[k]:cut[k + 1]].tobytes() for k in some], pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for t in C.by_group(batches, ["anchor", "salt"]):
            n = sum(int(C.column_bytes(c)[1][-1]) for c in t.column("bytes").chunks)
            if held and size + n > block:
                yield from solve(held)
                held, size = [], 0
            # a group whose hash share exceeds the block limit is still one block: salts bound it
            held.append(t)
            size += n + t.num_rows
        if held:
            yield from solve(held)

    key = ["anchor", "salt"]
    return (segs.repartition(*key).sortWithinPartitions(*key, "_uid", "start")
            .mapInArrow(run, "_uid long, start long, stop long, bucket int, firsts binary"))


def _across_blocks(found: DataFrame, length: int) -> DataFrame:
    """(_uid, start, stop) of the windows whose equal in another block is earlier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.by_group(batches, ["bucket"]):
            d1, d2, uid, start = C.ragged(t.column("firsts").combine_chunks(), np.int64)[0].reshape(-1, 4).T
            o = np.lexsort((start, uid, d2, d1))
            d1, d2, uid, start = d1[o], d2[o], uid[o], start[o]
            later = np.zeros(len(d1), bool)
            later[1:] = (d1[1:] == d1[:-1]) & (d2[1:] == d2[:-1])
            uid, start = uid[later], start[later]
            if len(uid):
                ids, code = np.unique(uid, return_inverse=True)
                who, a, b = _runs(code, start, length)
                yield pa.RecordBatch.from_arrays([pa.array(ids[who]), pa.array(a), pa.array(b)], ["_uid", "start", "stop"])

    return (found.filter("bucket is not null").select("bucket", "firsts").repartition("bucket")
            .sortWithinPartitions("bucket").mapInArrow(run, "_uid long, start long, stop long"))


def repeated_spans(docs: DataFrame, length: int = 100, block: int = BLOCK) -> DataFrame:
    """(_uid, spans): per document with repeated bytes, the spans to remove as an
    array of (start, stop), possibly overlapping."""
    spots = anchors(docs, length)
    again = spots.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    rows = C.save(spots.join(again, "anchor"), "anchors")
    firsts = C.save(rows.groupBy("anchor", "content").agg(
        F.min(F.struct("_uid", "place")).alias("f"), F.count(F.lit(1)).alias("copies"))
        .select("anchor", "content", "copies", F.col("f._uid").alias("u"), F.col("f.place").alias("p")), "segments")
    copied = (rows.join(firsts.filter("copies > 1"), ["anchor", "content"])
              .filter("_uid != u or place != p")
              .select("_uid", F.shiftright("place", 16).alias("start"),
                      (F.shiftright("place", 16) + F.col("place").bitwiseAND(0xFFFF)).alias("stop")))
    mixed = firsts.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"),
        F.ceil(F.sum(F.col("p").bitwiseAND(0xFFFF) + 1) / F.lit(block * 3 // 4)).cast("int").alias("salts")).filter("kinds > 1")
    first = (firsts.join(mixed, "anchor")
             .select("anchor", "salts", F.col("u").alias("_uid"), F.col("p").alias("place")))
    found = C.save(_transformed(_indexed_segments(docs, first, length), length, block), "repeats")
    spans = (copied.unionByName(found.filter("bucket is null").select("_uid", "start", "stop"))
             .unionByName(_across_blocks(found, length)))
    return spans.groupBy("_uid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # within one text


def _union(spans, n: int) -> tuple[np.ndarray, np.ndarray]:
    s = spans.field("start").to_numpy(zero_copy_only=False)
    e = spans.field("stop").to_numpy(zero_copy_only=False)
    o = np.argsort(s, kind="stable")
    s, e = s[o], np.maximum.accumulate(e[o])
    at = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
    return s[at], e[np.append(at[1:], len(s)) - 1]


def _kept(raw: bytes, s: np.ndarray, e: np.ndarray) -> bytes:
    edges = [0, *np.stack([s, e], 1).ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _with_spans(docs: DataFrame, length: int) -> DataFrame:
    return packed_texts(docs).join(repeated_spans(docs, length), "_uid", "left")


def _spans_of(b: pa.RecordBatch, i: int, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    spans = b.column(b.schema.get_field_index("spans"))[i]
    return _union(spans.values, len(raw)) if spans.is_valid else (np.zeros(0, np.int64),) * 2


def removal_report(docs: DataFrame, length: int = 100) -> DataFrame:
    """One row per row of ``docs`` (which has ``_uid``): (_uid, n_bytes, n_removed,
    n_spans, kept_sha256)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for b, i, raw in _unpacked(batches):
            s, e = _spans_of(b, i, raw)
            out.append((b.column(0)[i].as_py(), len(raw), int((e - s).sum()), len(s),
                        hashlib.sha256(_kept(raw, s, e)).hexdigest()))
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)

    names = ["_uid", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = pa.schema([(n, pa.string() if n == "kept_sha256" else pa.int64()) for n in names])
    return (_with_spans(docs, length).select("_uid", "z", "spans")
            .mapInArrow(run, "_uid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def trimmed_texts(docs: DataFrame, length: int = 100) -> DataFrame:
    """(_uid, text): the text without its repeated bytes.  A character that only
    partly lies in a removed span stays, so that the text remains valid UTF-8."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for b, i, raw in _unpacked(batches):
            s, e = _spans_of(b, i, raw)
            if len(s):
                inner = np.append((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80, False)
                s, e = s.copy(), e.copy()
                while (m := inner[s]).any():
                    s += m
                while (m := inner[e]).any():
                    e -= m
                ok = e > s
                s, e = s[ok], e[ok]
            ids.append(b.column(0)[i].as_py())
            texts.append(_kept(raw, s, e).decode("utf-8", "replace"))
            size += len(raw)
            if size > C.BLOCK_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["_uid", "text"])
                ids, texts, size = [], [], 0
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["_uid", "text"])

    return _with_spans(docs, length).select("_uid", "z", "spans").mapInArrow(run, "_uid long, text string")
