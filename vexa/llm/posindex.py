"""Benchmark decontamination with a distributed positional inverted index (operator 10).

``build_index`` stores the postings of every word of the corpus: one row per block of
documents, holding the block's distinct terms, their counts and the
delta-coded word positions.  A document lies in one block, so the lists of a phrase
can be intersected inside the block; no posting is ever shuffled and a
frequent term is only a longer list in each block.

``phrase_matches`` takes the test passages in chunks of at most ``CHUNK_WINDOWS`` windows or so, whatever their width; a longer item is
cut into pieces that overlap by a window less a word, so that the pieces have the windows of the item.  The index gives the corpus
frequency of each test term; in each block a window starts from the positions of its
rarest term, shifted by the term's offset, and is intersected with the shifted lists of
its next rarest terms until it is empty or all terms are found.  ``proximity_matches`` keeps
occurrences of the rarest term with every other term within ``slop`` words.

Terms are 64-bit hashes of the lower-cased words.  Null and empty texts have no
words, match nothing and are kept.  Repeated rows are separate documents with equal
results.  A null item id is reported as ``null``; items that share an id count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexa.llm import common as C

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

CHUNK_WINDOWS = 100_000  # windows of test items held by the driver and broadcast at once
WORD_GUESS = 2  # bytes of the shortest word with its blank: a text has no more words than its bytes by this

INDEX_SCHEMA = ("uids binary, first binary, terms binary, counts binary, positions binary")
HIT_SCHEMA = "_uid long, starts array<int>, ends array<int>, items array<string>"


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term hashes, first word of each text)."""
    low = C.LOWER_AZ[data]
    start, end, first = C.word_spans(WORD_BYTE[low], offs)
    return C.word_hashes(low, start, end), first


def build_index(docs: DataFrame, block_bytes: int = 4 << 20) -> DataFrame:
    """Write the positional index of ``docs`` (``_uid``, ``text``) and return it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in C.text_blocks(batches, limit=block_bytes):
            h, first = tokens(data, offs)
            order = np.argsort(h, kind="stable").astype(np.int32)
            h = h[order]
            at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            delta = np.diff(order, prepend=np.int32(0))
            delta[at] = order[at]
            parts = [C.longs(rows, "_uid"), first.astype(np.int32), h[at],
                     np.diff(np.append(at, len(h))).astype(np.int32), delta.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts],
                                             ["uids", "first", "terms", "counts", "positions"])

    return C.save(docs.select(C.UID, "text").mapInArrow(run, INDEX_SCHEMA), "posindex")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    kinds = {"uids": np.int64, "first": np.int32, "terms": np.uint64, "counts": np.int32, "positions": np.int32}
    for b in batches:
        for r in range(b.num_rows):
            yield {n: np.frombuffer(memoryview(c[r].as_buffer()), kinds[n]) for n, c in zip(b.schema.names, b.columns)}


class Windows:
    """Distinct windows of a chunk of test items, with the items of each."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        texts = pa.array([t for _, t in items], pa.string())
        data, offs = C.column_bytes(texts)
        h, first = tokens(data, offs)
        self.vocab, inv = np.unique(h, return_inverse=True)
        self.names = sorted({n for n, _ in items})
        at = {n: i for i, n in enumerate(self.names)}
        rows, owner = [], []
        for i, (name, _) in enumerate(items):
            a, b = int(first[i]), int(first[i + 1])
            if b == a:
                continue
            if b - a < width:
                rows.append(np.pad(inv[a:b], (0, width - (b - a)), constant_values=-1)[None, :])
            else:
                rows.append(np.lib.stride_tricks.sliding_window_view(inv[a:b], width))
            owner += [at[name]] * len(rows[-1])
        m = np.concatenate(rows).astype(np.int32) if rows else np.zeros((0, width), np.int32)
        self.terms, back = np.unique(m, axis=0, return_inverse=True) if len(m) else (m, np.zeros(0, np.int64))
        pairs = np.unique(np.stack([back.ravel(), np.asarray(owner, np.int64)], 1), axis=0) if len(m) \
            else np.zeros((0, 2), np.int64)
        self.items = pairs[:, 1]
        self.item_at = np.searchsorted(pairs[:, 0], np.arange(len(self.terms) + 1))
        self.length = (self.terms >= 0).sum(axis=1)
        self.order = np.zeros(self.terms.shape, np.int16)

    def rank(self, freq: np.ndarray) -> None:
        """Order the terms of every window by corpus frequency, rarest first."""
        cost = np.where(self.terms >= 0, freq[self.terms], np.iinfo(np.int64).max) if len(self.terms) else self.terms
        self.order = np.argsort(cost, axis=1, kind="stable").astype(np.int16)


class Block:
    """The postings of one block, decoded for lookups."""

    def __init__(self, p: dict, vocab: np.ndarray):
        self.uids, self.first = p["uids"], p["first"].astype(np.int64)
        ends = np.cumsum(p["counts"], dtype=np.int64)
        begin = ends - p["counts"]
        spot = np.searchsorted(p["terms"], vocab)
        known = spot < len(p["terms"])
        known[known] = p["terms"][spot[known]] == vocab[known]
        self.df = np.zeros(len(vocab), np.int64)
        self.df[known] = p["counts"][spot[known]]
        # decode the lists of the test terms alone
        self.at = np.concatenate([[0], np.cumsum(self.df)])
        src = np.arange(self.at[-1]) - np.repeat(self.at[:-1], self.df)
        lists = np.zeros(len(vocab), np.int64)
        lists[known] = begin[spot[known]]
        delta = p["positions"][src + np.repeat(lists, self.df)].astype(np.int64)
        run = np.cumsum(delta)
        base = np.concatenate([[0], run])[self.at[:-1]]
        self.pos = run - np.repeat(base, self.df)
        self.key = (np.repeat(np.arange(len(vocab), dtype=np.int64), self.df) << 32) | self.pos

    def has(self, term: np.ndarray, pos: np.ndarray) -> np.ndarray:
        want = (term.astype(np.int64) << 32) | pos
        spot = np.searchsorted(self.key, want)
        return (spot < len(self.key)) & (self.key[np.minimum(spot, len(self.key) - 1)] == want)

    def near(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the term has a posting in [low, high]."""
        term = term.astype(np.int64) << 32
        spot = np.searchsorted(self.key, term | low)
        return (spot < len(self.key)) & (self.key[np.minimum(spot, len(self.key) - 1)] <= (term | high))

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, pos, side="right") - 1


def _chunks(df: np.ndarray, limit: int) -> Iterator[slice]:
    """Runs of windows whose first lists hold at most ``limit`` postings together."""
    total = np.cumsum(df)
    i = 0
    while i < len(df):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + limit, side="right")))
        yield slice(i, j)
        i = j


def _present(blk: Block, w: Windows) -> np.ndarray:
    seen = np.append(blk.df > 0, True)  # index -1: padding
    return np.flatnonzero(seen[w.terms].all(axis=1)) if len(w.terms) else np.zeros(0, np.int64)


def _starts(blk: Block, w: Windows, live: np.ndarray, step: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, position of its rarest term), in bounded portions."""
    rare = w.terms[live, w.order[live, 0]]
    for part in _chunks(blk.df[rare], step):
        t = rare[part]
        n = blk.df[t]
        idx = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(blk.at[t], n)
        yield np.repeat(live[part], n), blk.pos[idx]


def exact(blk: Block, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of every occurrence inside one document."""
    found_w, found_s = [], []
    for win, pos in _starts(blk, w, _present(blk, w)):
        start = pos - w.order[win, 0]
        ok = start >= 0
        win, start = win[ok], start[ok]
        ok = blk.first[np.minimum(blk.doc_of(start) + 1, len(blk.first) - 1)] >= start + w.length[win]
        win, start = win[ok], start[ok]
        for j in range(1, w.terms.shape[1]):
            if not len(win):
                break
            off = w.order[win, j]
            more = j < w.length[win]
            ok = ~more
            ok[more] = blk.has(w.terms[win[more], off[more]], start[more] + off[more])
            win, start = win[ok], start[ok]
        found_w.append(win)
        found_s.append(start)
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_w), np.concatenate(found_s)) if found_w else (none, none)


def _merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals that come sorted by start."""
    if not len(start):
        return start, end
    top = np.maximum.accumulate(end)
    new = np.concatenate([[True], start[1:] > top[:-1]])
    at = np.flatnonzero(new)
    return start[at], top[np.append(at[1:], len(start)) - 1]


def _cut_items(named: DataFrame, width: int, words: int) -> DataFrame:
    """Items of more than ``words`` words as pieces of that many, each beginning ``width`` - 1 words before the last one's end."""
    schema = named.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = text.encode()
                data = np.frombuffer(raw, np.uint8)
                start, end, _ = C.word_spans(WORD_BYTE[C.LOWER_AZ[data]], np.array([0, len(data)]))
                at = 0
                while True:
                    last = min(at + words, len(start))
                    piece = raw[start[at]:end[last - 1]].decode("utf-8", "replace") if last > at else ""
                    yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([piece], pa.string())], schema.names)
                    if last == len(start):
                        break
                    at = last - (width - 1)

    return named.mapInArrow(cut, schema)


def _chunked_items(items: DataFrame, id_col: str, width: int, windows: int) -> list[DataFrame]:
    named = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("name"),
                         F.coalesce("text", F.lit("")).alias("text"))
    chunk_bytes = max(windows, 2 * width) * WORD_GUESS
    long = F.octet_length("text") > chunk_bytes
    pieces = named.filter(~long).unionByName(_cut_items(named.filter(long), width, max(windows, 2 * width)))
    pieces = C.save(pieces.distinct(), "items")  # copies of an item would all fall into one chunk
    size = pieces.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0
    # texts have about six bytes a word, so that a chunk holds some ``windows`` of them
    n = max(1, -(-size // (6 * windows)))
    return [pieces.filter(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == i) for i in range(n)]


def _ranked(index: DataFrame, chunk: DataFrame, width: int) -> Windows:
    """The windows of one bounded chunk, ordered by the index's frequencies."""
    w = Windows(sorted({(r.name, r.text) for r in chunk.collect()}), width)
    vocab = index.sparkSession.sparkContext.broadcast(w.vocab)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocab.value), np.int64)
        for p in _parts(batches):
            spot = np.searchsorted(p["terms"], vocab.value)
            ok = spot < len(p["terms"])
            ok[ok] = p["terms"][spot[ok]] == vocab.value[ok]
            total[ok] += p["counts"][spot[ok]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    freq = np.zeros(len(w.vocab), np.int64)
    rows = index.select("terms", "counts").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # at most the vocabulary of the chunk
        freq[r.term] = r.n
    w.rank(freq)
    return w


def phrase_matches(index: DataFrame, items: DataFrame, id_col: str = "item_id", width: int = 13,
                   windows: int = CHUNK_WINDOWS) -> DataFrame:
    """(_uid, starts, ends, items): per document with a match the merged word spans
    covered by occurrences of windows of ``width`` words of any item (an item of
    fewer words is one window), and the items concerned."""
    parts = []
    for chunk in _chunked_items(items, id_col, width, windows):
        shared = index.sparkSession.sparkContext.broadcast(_ranked(index, chunk, width))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            w = shared.value
            names = pa.array(w.names, pa.string())
            for p in _parts(batches):
                blk = Block(p, w.vocab)
                win, start = exact(blk, w)
                if not len(win):
                    continue
                doc = blk.doc_of(start)
                o = np.argsort(start, kind="stable")
                s, e = start[o], start[o] + w.length[win[o]]
                # spans of one document never reach into the next
                s, e = _merge(s, e)
                cut = doc_cuts(blk, s, e)
                s, e, owner = cut
                hit = np.unique(owner)
                pair = np.unique((doc << 32) | win)
                d, k = pair >> 32, pair & 0xFFFFFFFF
                n = w.item_at[k + 1] - w.item_at[k]
                idx = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(w.item_at[k], n)
                both = np.unique((np.repeat(d, n) << 32) | w.items[idx])
                base = blk.first[owner]
                at = np.append(np.searchsorted(owner, hit), len(owner)).astype(np.int32)
                item_at = np.append(np.searchsorted(both >> 32, hit), len(both)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(blk.uids[hit]),
                    pa.ListArray.from_arrays(at, pa.array((s - base).astype(np.int32))),
                    pa.ListArray.from_arrays(at, pa.array((e - base).astype(np.int32))),
                    pa.ListArray.from_arrays(item_at, names.take(pa.array(both & 0xFFFFFFFF)))],
                    ["_uid", "starts", "ends", "items"])

        parts.append(index.mapInArrow(run, HIT_SCHEMA))
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return _merge_chunks(every)


def doc_cuts(blk: Block, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Split merged spans at document bounds; (start, end, document)."""
    a, b = blk.doc_of(s), blk.doc_of(e - 1)
    n = b - a + 1
    owner = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    s2 = np.maximum(np.repeat(s, n), blk.first[owner])
    e2 = np.minimum(np.repeat(e, n), blk.first[owner + 1])
    ok = e2 > s2
    return s2[ok], e2[ok], owner[ok]


def _merge_chunks(hits: DataFrame) -> DataFrame:
    """One row per document from the rows of several chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.by_group(batches, ["_uid"]):
            s = t.column("starts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            e = t.column("ends").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            o = np.argsort(s, kind="stable")
            s, e = _merge(s[o], e[o])
            items = sorted(set(t.column("items").combine_chunks().flatten().to_pylist()))
            yield pa.RecordBatch.from_arrays([
                t.column("_uid").combine_chunks().slice(0, 1), pa.array([s.tolist()], pa.list_(pa.int32())),
                pa.array([e.tolist()], pa.list_(pa.int32())), pa.array([items], pa.list_(pa.string()))],
                ["_uid", "starts", "ends", "items"])

    n = C.shuffle_partitions(hits.sparkSession)
    return hits.repartition(n, "_uid").sortWithinPartitions("_uid").mapInArrow(run, HIT_SCHEMA)


def proximity_matches(index: DataFrame, items: DataFrame, id_col: str = "item_id", slop: int = 8,
                      windows: int = CHUNK_WINDOWS // 4) -> DataFrame:
    """(_uid, item, position): occurrences of an item's rarest word, by word number
    in the document, with all its other words at most ``slop`` words away in the
    same document, in any order.  Items of more than 64 distinct words never
    match as a whole and are searched by their windows of 64 words."""
    out = None
    for chunk in _chunked_items(items, id_col, 64, windows):
        shared = index.sparkSession.sparkContext.broadcast(_ranked(index, chunk, 64))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            w = shared.value
            for p in _parts(batches):
                blk = Block(p, w.vocab)
                for win, pos in _starts(blk, w, _present(blk, w)):
                    d = blk.doc_of(pos)
                    low = np.maximum(pos - slop, blk.first[d])
                    high = np.minimum(pos + slop, blk.first[d + 1] - 1)
                    keep = np.ones(len(win), bool)
                    for j in range(1, w.terms.shape[1]):
                        k = np.flatnonzero(keep & (j < w.length[win]))
                        if not len(k):
                            break
                        keep[k] = blk.near(w.terms[win[k], w.order[win[k], j]], low[k], high[k])
                    win, pos, d = win[keep], pos[keep], d[keep]
                    n = w.item_at[win + 1] - w.item_at[win]
                    idx = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(w.item_at[win], n)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(blk.uids[d], n)),
                        pa.array(w.names, pa.string()).take(pa.array(w.items[idx])),
                        pa.array(np.repeat(pos - blk.first[d], n).astype(np.int32))], ["_uid", "item", "position"])

        part = index.mapInArrow(run, "_uid long, item string, position int")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def word_counts(index: DataFrame) -> DataFrame:
    """(_uid, n_words) of every indexed document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _parts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(p["uids"]), pa.array(np.diff(p["first"]).astype(np.int64))],
                                             ["_uid", "n_words"])

    return index.select("uids", "first").mapInArrow(run, "_uid long, n_words long")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "item_id", width: int = 13,
                  share: int = 20) -> DataFrame:
    """One row per row of ``docs`` (which has ``_uid``): (_uid, n_words, n_hit, items,
    contaminated), contaminated where at least 1/``share`` of the words, and
    at least one, lie in an occurrence of a window of an item."""
    index = build_index(docs)
    hits = phrase_matches(index, items, id_col, width).select(
        "_uid", F.aggregate(F.zip_with("starts", "ends", lambda s, e: (e - s).cast("long")), F.lit(0).cast("long"),
                            lambda a, x: a + x).alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"))
    return (word_counts(index).join(hits, "_uid", "left")
            .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))))
