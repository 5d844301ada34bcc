"""Near duplicates by an inverted join on signature coordinates (operator 7).

1. Every text becomes its set of word shingles (64-bit hashes) and a MinHash
   signature of ``coords`` coordinates.  Texts with equal sets are one class,
   represented by the smallest id, so copies of a text are never paired.
2. Each representative is posted under its (coordinate, value) pairs.  Only
   pairs posted at least twice can collide, so a representative with fewer than
   ``matches`` of them is finished.  Of the rest, the rarest form its prefix:
   two signatures that agree on ``matches`` coordinates share one of them.
3. Representatives joined through prefix postings form candidate clusters.  A
   cluster is cut into blocks of bounded bytes, which are contracted to the components of their own links level by level;
   only rows that can still have a link to another component are compared across pairs of blocks (``verified_links``).  In a
   unit of work the short (prefix) lists are merged into candidate pairs, the
   long lists are skipped and their coordinates are looked up for the candidates
   only; pairs with at least ``matches`` collisions are verified on the full
   shingle sets.  A unit returns a spanning forest of its verified links, not the links.
4. Connected components of the links.

``matches`` follows from the similarity: a pair at the threshold agrees on fewer than that many
of 48 coordinates with probability 2e-6 at most (28 at similarity 0.85, 24 at 0.80).

Coordinates are 64-bit minima, so that documents without a common shingle share one by chance only about once in
2**64 / n pairs.  Null, empty or blank texts have no shingles and link with nothing.  A very long text is held as a whole by its task.  A text of
fewer words than a shingle is one shingle.  Repeated rows are copies; see
``common.identified`` for repeated or null ids.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexa.llm import common as C
from vexa.llm.components import connected_components

WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False
HELD_ROWS = 512  # rows whose keys are posted together


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, as (hashes, offsets)."""
    low = C.LOWER_AZ[data]
    start, end, first = C.word_spans(WORD_BYTE[low], offs)
    n_words = np.diff(first)
    h = C.word_hashes(low, start, end)
    texts = np.arange(len(offs) - 1)
    owner = np.repeat(texts, n_words)
    full = first[1:][owner] - np.arange(len(h)) >= words  # a whole shingle starts here
    at = np.flatnonzero(full)
    base = np.zeros(len(at), np.uint64)
    for j in range(words):
        base = C.mix(base * np.uint64(31) + h[at + j] + np.uint64(j))
    who = owner[at]
    short = np.flatnonzero((n_words > 0) & (n_words < words))
    extra = np.zeros(len(short), np.uint64)
    for j in range(words - 1):
        has = n_words[short] > j
        extra[has] = C.mix(extra[has] * np.uint64(31) + h[first[short[has]] + j] + np.uint64(1000 + j))
    base, who = np.concatenate([base, extra]), np.concatenate([who, short])
    order = np.lexsort((base, who))
    base, who = base[order], who[order]
    new = np.ones(len(base), bool)
    new[1:] = (base[1:] != base[:-1]) | (who[1:] != who[:-1])
    base, who = base[new], who[new]
    return base, np.searchsorted(who, np.arange(len(offs)))


def _multipliers(coords: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**64, coords, np.uint64) | np.uint64(1)


def signatures(docs: DataFrame, words: int, coords: int) -> DataFrame:
    """(_uid, n, s1, s2, sig): set size, 128-bit set fingerprint, signature."""
    mult = _multipliers(coords)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in C.text_blocks(batches):
            sets, at = shingle_sets(data, offs, words)
            n = np.diff(at)
            some = np.flatnonzero(n)
            sig = np.zeros((len(n), coords), np.uint64)
            s1, s2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(some):
                cut = at[some]
                s1[some] = np.add.reduceat(C.mix(sets + np.uint64(11)), cut)
                s2[some] = np.add.reduceat(C.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), cut)
                for c in range(coords):
                    sig[some, c] = np.minimum.reduceat(sets * mult[c], cut)
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                C.binary_column(sig.view(np.uint8).ravel(), np.arange(len(n) + 1) * 8 * coords)],
                ["_uid", "n", "s1", "s2", "sig"])

    return docs.select(C.UID, "text").mapInArrow(run, "_uid long, n long, s1 long, s2 long, sig binary")


def _coordinate_keys(sig: pa.Array, coords: int) -> np.ndarray:
    """Keys that name coordinate and value, ``coords`` for each signature."""
    s, _ = C.ragged(sig, np.uint64)
    return C.mix(s ^ np.tile(C.mix(np.arange(1, coords + 1, dtype=np.uint64)), len(sig)))


def _postings(reps: DataFrame, coords: int) -> DataFrame:
    """(_uid, key): one row per coordinate; the key names coordinate and value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cols = [np.repeat(C.longs(b, "_uid"), coords), _coordinate_keys(b.column(1), coords).view(np.int64)]
            for i in range(0, len(cols[1]), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(c[i:i + (1 << 18)]) for c in cols], ["_uid", "key"])

    return reps.select("_uid", "sig").mapInArrow(run, "_uid long, key long")


def prefixes(reps: DataFrame, coords: int, matches: int) -> DataFrame:
    """(_uid, keys): the rarest repeated keys of each representative that has
    at least ``matches`` repeated keys, enough of them that two signatures
    with ``matches`` equal coordinates share one."""
    post = _postings(reps, coords)
    df = post.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ranked = (post.join(df, "key").groupBy("_uid")
              .agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("k")))  # at most ``coords`` entries
    return (ranked.filter(F.size("k") >= matches)
            .select("_uid", F.expr(f"transform(slice(k, 1, size(k) - {matches - 1}), x -> x.key)").alias("keys")))


def clusters(prefix: DataFrame) -> DataFrame:
    """(_uid, cluster): representatives connected through prefix keys."""
    post = prefix.select("_uid", F.explode("keys").alias("key"))
    hub = post.groupBy("key").agg(F.min("_uid").alias("hub"))
    return (connected_components(post.join(hub, "key").select("_uid", "hub"), "_uid", "hub")
            .select(F.col("node").alias("_uid"), F.col("component").alias("cluster")))


def _local_links(t: pa.Table, matches: int, ratio: tuple[int, int], chunk: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the verified links of one pair of blocks."""
    uid, block, part = C.longs(t, "_uid"), C.longs(t, "block"), C.longs(t, "part")
    cross = bool(C.longs(t, "bi")[0] != C.longs(t, "bj")[0])
    order = np.lexsort((uid, block))
    uid, block, part = uid[order], block[order], part[order]
    t = t.take(pa.array(order))
    n = len(uid)
    # cross units compare the rows of one block with those of the other
    left = np.flatnonzero(block == block[0]) if cross else np.arange(n)
    right = np.flatnonzero(block != block[0]) if cross else np.arange(n)
    if n < 2 or not len(right):
        return uid[:0], uid[:0]
    keys, kat = C.ragged(t.column("keys").combine_chunks(), np.uint64)
    sig = C.ragged(t.column("sig").combine_chunks(), np.uint64)[0].reshape(n, -1)
    sets, sat = C.ragged(t.column("shingles").combine_chunks(), np.uint64)
    size = np.diff(sat)
    # merge the short lists: rows that share a prefix key are candidates
    cand = np.zeros((n, n), bool)
    who = np.repeat(np.arange(n), np.diff(kat))
    o = np.argsort(keys, kind="stable")
    k, w = keys[o], who[o]
    cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a > 1:
            m = w[a:b]
            cand[np.ix_(m, m)] = True
    if cross:
        cand[np.ix_(left, left)] = False
        cand[np.ix_(right, right)] = False
    cand &= part[:, None] != part[None, :]  # connected already
    i, j = np.nonzero(np.triu(cand, 1))
    # skipped lists: look the other coordinates up for the candidates alone
    hits = np.zeros(len(i), np.int32)
    for c in range(sig.shape[1]):
        hits += sig[i, c] == sig[j, c]
    ok = hits >= matches
    i, j = i[ok], j[ok]
    if not len(i):
        return uid[:0], uid[:0]
    # exact intersections over the shingles that occur in more than one row
    vals, inv, cnt = np.unique(sets, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    live = cnt > 1
    ids = np.cumsum(live) - 1
    keep = live[inv]
    col, row = ids[inv[keep]], row[keep]
    total = int(live.sum())
    inter = np.zeros((n, n), np.float32)
    o = np.argsort(col, kind="stable")
    col, row = col[o], row[o]
    for lo in range(0, total, chunk):
        a, b = np.searchsorted(col, [lo, lo + chunk])
        x = np.zeros((n, min(chunk, total - lo)), np.float32)
        x[row[a:b], col[a:b] - lo] = 1
        inter += x @ x.T
    both = inter[i, j].astype(np.int64)
    ok = ratio[1] * both >= ratio[0] * (size[i] + size[j] - both)
    link = np.zeros((n, n), bool)
    link[i[ok], j[ok]] = link[j[ok], i[ok]] = True
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(link, label[None, :], n).min(axis=1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return uid[moved], uid[label[moved]]


def _compared(placed: DataFrame, part: DataFrame | None, size: str, block_bytes: int, matches: int, ratio: tuple[int, int],
              crossing: bool) -> DataFrame:
    """(a, b): a spanning forest of the links between rows of ``placed`` that share a cluster but no ``part`` (_uid, part; by default
    each row is its own).  Rows are dealt to blocks of about ``block_bytes``; with ``crossing`` every pair of blocks is a
    unit of work, else each block alone."""
    spark = placed.sparkSession
    rows = placed.join(part, "_uid") if part is not None else placed.withColumn("part", F.col("_uid"))
    blocks = rows.groupBy("cluster").agg(F.ceil(F.sum(size) / F.lit(block_bytes)).cast("int").alias("blocks"))
    dealt = rows.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("_uid"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)) if crossing else F.col("block")
    units = (dealt.withColumn("other", others)
             .select("_uid", "part", "cluster", "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                     "sig", "keys", "shingles"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.by_group(batches, ["cluster", "bi", "bj"]):
            a, b = _local_links(t, matches, ratio)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    key = ["cluster", "bi", "bj"]
    return C.save(units.repartition(C.shuffle_partitions(spark), *key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long"), "links")


def verified_links(docs: DataFrame, reps: DataFrame, prefix: DataFrame, words: int, coords: int, matches: int,
                   ratio: tuple[int, int], block_bytes: int) -> DataFrame:
    """(a, b): links that connect the same representatives as all links do.

    A cluster of one block is settled by one unit.  A larger one is contracted first: its blocks are settled each on its own,
    then one row of every component found so far goes on to the next level, in blocks again, until they
    fit one block or fall no further; a family of near copies thus shrinks by the size of a block at each level.  What is left are links between
    different components.  A row can have one only if one of its prefix keys, and at least ``matches`` of all its coordinates, also occur in
    another component; these rows alone are compared across all pairs of blocks."""
    member = C.save(clusters(prefix), "clusters")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in C.text_blocks(batches):
            s, at = shingle_sets(data, offs, words)
            yield pa.RecordBatch.from_arrays([rows.column(0), C.binary_column(s.view(np.uint8), at * 8)],
                                             ["_uid", "shingles"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(b.schema.get_field_index("keys"))
            flat = keys.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            offs = np.concatenate([[0], np.cumsum(np.asarray(keys.value_lengths()))]) if b.num_rows else np.zeros(1)
            cols = [C.binary_column(flat.view(np.uint8), offs.astype(np.int64) * 8) if n == "keys" else c
                    for n, c in zip(b.schema.names, b.columns)]
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    wanted = docs.select(C.UID, "text").join(member.select("_uid"), "_uid", "left_semi")
    shingled = wanted.mapInArrow(sets, "_uid long, shingles binary")
    rows = (reps.select("_uid", "n", "sig").join(member, "_uid").join(prefix, "_uid")
            .select("_uid", (F.col("n") * 8 + 1024).alias("size"), "cluster", "sig", "keys")
            .mapInArrow(pack, "_uid long, size long, cluster long, sig binary, keys binary"))
    placed = C.save(rows.join(shingled, "_uid"), "candidates")
    links = _compared(placed, None, "size", block_bytes, matches, ratio, crossing=False)
    wide = C.save(placed.groupBy("cluster").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
                  .filter(F.col("bytes") > block_bytes).select("cluster", "n"), "wide")
    left = wide.agg(F.sum("n")).first()[0] or 0
    if not left:
        return links
    open_rows = placed.join(wide.select("cluster"), "cluster", "left_semi")
    while True:
        part = C.save(_parts_of(open_rows, links), "parts")
        heads = part.filter("_uid = part").select("_uid")
        now = heads.count()
        wider = open_rows.join(heads, "_uid", "left_semi").groupBy("cluster").agg(F.sum("size").alias("b")).filter(F.col("b") > block_bytes)
        again = 2 * now <= left and now > 1
        if again:
            level = _compared(open_rows.join(heads, "_uid", "left_semi"), None, "size", block_bytes, matches, ratio, crossing=False)
            links = C.save(links.unionByName(level), "links")
        if not again or not wider.limit(1).count():
            break
        left = now
    part = C.save(_parts_of(open_rows, links).join(member, "_uid"), "parts")
    several = part.groupBy("cluster").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high").select("cluster")
    part = C.save(part.join(several, "cluster", "left_semi"), "parts")
    # a link to another component needs a prefix key that occurs there, and enough of all keys
    near = C.save(part.join(open_rows.select("_uid", "keys", "sig"), "_uid"), "several")
    near = near.join(_held_elsewhere(near.select("_uid", "cluster", "part", "keys"), 1), "_uid", "left_semi")
    enough = _held_elsewhere(_all_keys(near, coords), matches)
    last = C.save(open_rows.join(enough, "_uid", "left_semi"), "open")
    return links.unionByName(_compared(last, part.select("_uid", "part"), "size", block_bytes, matches, ratio, crossing=True))


def _all_keys(rows: DataFrame, coords: int) -> DataFrame:
    """(_uid, cluster, part, keys): the keys of all coordinates, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = _coordinate_keys(b.column(3), coords)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], C.binary_column(key.view(np.uint8), np.arange(b.num_rows + 1) * 8 * coords)],
                                             ["_uid", "cluster", "part", "keys"])

    return rows.select("_uid", "cluster", "part", "sig").mapInArrow(run, "_uid long, cluster long, part long, keys binary")


def _block_keys(dealt: DataFrame) -> DataFrame:
    """(cluster, block, key, low, high): each key once per block of rows (_uid, cluster, part, keys, block), with its least and largest part.
    Near copies share most of their keys, so a family posts them once per block and not once per row."""
    by = ["cluster", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.by_group(batches, by):
            keys, at = C.ragged(t.column("keys").combine_chunks(), np.uint64)
            part = np.repeat(C.longs(t, "part"), np.diff(at))
            order = np.lexsort((part, keys))
            keys, part = keys[order], part[order]
            cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(1, np.int64)
            cols = [np.full(len(cut) - 1, t.column(c)[0].as_py(), np.int64) for c in by]
            cols += [keys[cut[:-1]].view(np.int64), part[cut[:-1]], part[cut[1:] - 1]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], [*by, "key", "low", "high"])

    dealt = dealt.repartition(C.shuffle_partitions(dealt.sparkSession), *by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, "cluster long, block long, key long, low long, high long")


def _held_elsewhere(rows: DataFrame, least: int) -> DataFrame:
    """(_uid) of the rows (_uid, cluster, part, keys packed) with at least ``least`` keys that another part of the cluster holds too.

    Rows are dealt to blocks of about ``HELD_ROWS``; keys travel once per block, those found in several parts go back to the blocks that hold them."""
    by = ["cluster", "block"]
    blocks = rows.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / F.lit(HELD_ROWS)).cast("long").alias("blocks"))
    dealt = C.save(rows.join(blocks, "cluster").select("_uid", "cluster", "part", "keys", F.pmod(F.xxhash64("_uid"), "blocks").alias("block")), "dealt")
    posted = C.save(_block_keys(dealt), "posted")
    mixed = (posted.groupBy("cluster", "key").agg(F.min("low").alias("low"), F.max("high").alias("high"))
             .filter("low <> high").select("cluster", "key"))
    back = posted.join(mixed, ["cluster", "key"], "left_semi").select("cluster", "block", F.col("key").alias("id"), F.lit(None).cast("binary").alias("keys"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.by_group(batches, by):
            packed, ids = t.column("keys").combine_chunks(), C.longs(t, "id")
            row = packed.is_valid().to_numpy(zero_copy_only=False)
            keys, at = C.ragged(packed.filter(pa.array(row)), np.uint64)
            held = np.isin(keys, ids[~row].view(np.uint64))
            n = np.bincount(np.repeat(np.arange(len(at) - 1), np.diff(at)), weights=held, minlength=len(at) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(ids[row][n >= least])], ["_uid"])

    both = dealt.select("cluster", "block", F.col("_uid").alias("id"), "keys").unionByName(back)
    return both.repartition(C.shuffle_partitions(rows.sparkSession), *by).sortWithinPartitions(*by).mapInArrow(run, "_uid long")


def _parts_of(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(_uid, part): the component of each row so far, named by its smallest row."""
    found = connected_components(links, "a", "b").select(F.col("node").alias("_uid"), "component")
    return rows.select("_uid").join(found, "_uid", "left").select("_uid", F.coalesce("component", "_uid").alias("part"))


def least_matches(coords: int, ratio: tuple[int, int], miss: float = 2e-6) -> int:
    """Largest number of equal coordinates that a pair of similarity ``ratio`` falls short of with
    probability ``miss`` at most."""
    p, short = ratio[0] / ratio[1], 0.0
    for m in range(coords):
        short += comb(coords, m) * p**m * (1 - p)**(coords - m)
        if short > miss:
            return max(m, 1)
    return coords


def near_duplicates(docs: DataFrame, words: int = 5, ratio: tuple[int, int] = (85, 100), coords: int = 48,
                    matches: int | None = None, block_bytes: int = 1 << 20) -> DataFrame:
    """One row per row of ``docs`` (which has ``_uid``, see ``common.identified``):
    (_uid, n_shingles, component, kept).  Texts whose sets have a Jaccard similarity of at least
    ``ratio`` (numerator, denominator) are linked."""
    matches = least_matches(coords, ratio) if matches is None else matches
    sigs = C.save(signatures(docs, words, coords), "signatures")
    classes = sigs.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("_uid").alias("rep"))
    owner = C.save(sigs.select("_uid", "n", "s1", "s2").join(classes, ["n", "s1", "s2"], "left")
                   .select("_uid", "n", F.coalesce("rep", "_uid").alias("rep")), "classes")
    reps = sigs.filter("n > 0").join(owner.filter("_uid = rep").select("_uid"), "_uid", "left_semi")
    prefix = C.save(prefixes(reps, coords, matches), "prefixes")
    links = verified_links(docs, reps, prefix, words, coords, matches, ratio, block_bytes)
    comp = connected_components(links, "a", "b").select(F.col("node").alias("rep"), "component")
    return (owner.join(comp, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
            .select("_uid", F.col("n").alias("n_shingles"), "component",
                    (F.col("_uid") == F.col("component")).alias("kept")))
