"""Toxicity by subword-bag embeddings averaged into a linear softmax (operator 1).

A word is a run of non-blank bytes, in ASCII lower case.  Its features are the whole
word and its byte 3-, 4- and 5-grams, with a blank at either end, hashed into
``buckets`` embeddings.  The embeddings of a word are averaged and a linear softmax gives the
log-odds of the label.  A text pools the log-odds of its words with a soft maximum, so that a
few bad words stand out in a text of any length.

Embeddings and softmax are trained jointly in NumPy, on the text labels only, by Adam
over a bounded sample: at most ``max_rows`` whole labelled texts per class, of any length, with a bound on
the bytes of their distinct words together.  A random half of the features of every word is left out in each step, so a word must be
recognisable by parts of it and an unseen misspelling is scored by the n-grams
that it shares.

Null, empty and blank texts score 0.  Without labels of both classes every text scores
0.  Repeated rows score alike; repeated labels of a document count as toxic
if one is.  Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexa.llm import common as C
from vexa.llm.minhash import WORD_BYTE

GRAMS = (3, 4, 5)
SHARP = 8.0  # of the soft maximum


def _layout(data: np.ndarray, offs: np.ndarray):
    """Lower-cased text with a blank before and after every word: (text, word starts, word
    ends, first word of each text)."""
    low = C.LOWER_AZ[data]
    start, end, first = C.word_spans(WORD_BYTE[low], offs)
    size = end - start
    # word i moves to its own place: one blank between neighbouring words
    new = np.cumsum(size + 1) - size
    text = np.full(int(size.sum()) + len(size) + 1, 0x20, np.uint8)
    idx = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    text[idx + np.repeat(new, size)] = low[idx + np.repeat(start, size)]
    return text, new, new + size, first


def _hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int):
    """Whole-word buckets, and per n-gram length (buckets by position, first, count per word)."""
    roll = C.RollingHash(text)
    whole = (roll.ranges(start, end) % np.uint64(buckets)).astype(np.int64)
    grams = []
    for n in GRAMS:
        h = (roll.windows(n) % np.uint64(buckets)).astype(np.int64)
        count = np.maximum(end + 1 - (start - 1) - n + 1, 0)
        grams.append((h, start - 1, count))
    return whole, grams


@dataclass
class Model:
    weight: np.ndarray  # log-odds of each bucket: embedding times softmax difference
    bias: float
    buckets: int
    known: bool


def word_logits(text: np.ndarray, start: np.ndarray, end: np.ndarray, m: Model) -> np.ndarray:
    whole, grams = _hashes(text, start, end, m.buckets)
    total, count = m.weight[whole].astype(np.float64), np.ones(len(start))
    for h, first, n in grams:
        run = np.concatenate([[0.0], np.cumsum(m.weight[h], dtype=np.float64)])
        top = np.minimum(first + n, len(h))
        total += np.where(n > 0, run[top] - run[np.minimum(first, len(h))], 0.0)
        count += n
    return total / count + m.bias


def pooled(z: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Soft maximum of the words of each text; minus infinity without words."""
    out = np.full(len(first) - 1, -np.inf)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        at = first[:-1][some]
        top = np.maximum.reduceat(z, at)
        spread = np.exp(SHARP * (z - np.repeat(top, np.diff(first)[some])))
        out[some] = top + np.log(np.add.reduceat(spread, at)) / SHARP
    return out


def fit(texts: list[bytes], labels: np.ndarray, buckets: int = 1 << 18, dim: int = 8, steps: int = 90,
        rate: float = 0.1, decay: float = 1e-4, seed: int = 5) -> Model:
    """Train on texts held in memory (the bounded sample)."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(buckets, np.float32), 0.0, buckets, False)
    data = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, start, end, first = _layout(data, offs)
    # distinct words, and the texts in which each occurs
    code = C.RollingHash(text).ranges(start, end)
    _, spot, word = np.unique(code, return_index=True, return_inverse=True)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    pair = np.unique(owner * np.int64(len(spot)) + word)
    owner, word = pair // len(spot), pair % len(spot)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    whole, grams = _hashes(text, start[spot], end[spot], buckets)
    feats, who = [whole.astype(np.int32)], [np.arange(len(spot), dtype=np.int32)]
    for h, at, n in grams:
        feats.append(h[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at, n)].astype(np.int32))
        who.append(np.repeat(np.arange(len(spot), dtype=np.int32), n))
    feats, who = np.concatenate(feats), np.concatenate(who)
    n_spots = len(spot)
    del text, start, end, code, spot, whole, grams, data  # the driver's memory is small

    rng = np.random.default_rng(seed)
    some = np.flatnonzero(np.diff(first))
    y = labels[some].astype(np.float64)
    at = first[:-1][some]
    n_words = np.diff(first)[some]
    balance = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    used, feats = np.unique(feats, return_inverse=True)
    feats = feats.astype(np.int32)
    table = rng.normal(0, 0.1, (len(used), dim)).astype(np.float32)
    soft = np.stack([-np.ones(dim), np.ones(dim)], 1).astype(np.float32) / dim
    bias = np.zeros(2)
    params = [table, soft, bias]
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        keep = rng.random(len(feats)) < 0.5
        f, w = feats[keep], who[keep]
        size = np.maximum(np.bincount(w, minlength=n_spots), 1)[:, None]
        vec = np.stack([np.bincount(w, table[f, d], n_spots) for d in range(dim)], 1) / size
        logits = vec @ soft + bias
        z = (logits[:, 1] - logits[:, 0])[word]
        top = np.maximum.reduceat(z, at)
        spread = np.exp(SHARP * (z - np.repeat(top, n_words)))
        norm = np.add.reduceat(spread, at)
        doc = top + np.log(norm) / SHARP
        err = (1 / (1 + np.exp(-doc)) - y) * balance
        dz = np.bincount(word, spread / np.repeat(norm, n_words) * np.repeat(err, n_words), n_spots)
        dlogits = np.stack([-dz, dz], 1)
        dvec = dlogits @ soft.T / size
        grads = [np.stack([np.bincount(f, dvec[w, d], len(used)) for d in range(dim)], 1) + decay * table / len(y),
                 vec.T @ dlogits, dlogits.sum(axis=0)]
        for p, g, a, b in zip(params, grads, mean, var):
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            p -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(p.dtype)
    weight = np.zeros(buckets, np.float32)
    weight[used] = table @ (soft[:, 1] - soft[:, 0])
    return Model(weight, float(bias[1] - bias[0]), buckets, True)


def distinct_words(data: np.ndarray) -> bytes:
    """The distinct words of one text; ``fit`` learns the same from them as from the text."""
    text, start, end, _ = _layout(data, np.array([0, len(data)]))
    _, spot = np.unique(C.RollingHash(text).ranges(start, end), return_index=True)
    return b" ".join(text[start[i]:end[i]].tobytes() for i in spot)


def word_lists(docs: DataFrame, marked: DataFrame, id_col: str, max_rows: int) -> DataFrame:
    """(id, y, words, size) of the ``max_rows`` labelled texts of either class that come first by hash of
    the id, whatever their length, written once."""
    chosen = None
    for y in (0, 1):
        first = marked.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_rows)
        chosen = first if chosen is None else chosen.unionByName(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in C.text_blocks(batches):
            words = [distinct_words(data[a:b]) for a, b in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(words, pa.binary())], ["id", "y", "words"])

    kind = dict(docs.dtypes)[id_col]
    found = docs.select(F.col(id_col).alias("id"), "text").join(F.broadcast(chosen), "id").select("id", "y", "text")
    lists = found.mapInArrow(run, f"id {kind}, y int, words binary").groupBy("id").agg(
        F.min("y").alias("y"), F.min("words").alias("words"))
    return C.save(lists.withColumn("size", F.octet_length("words")), "words")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic",
          max_rows: int = 1000, max_bytes: int = 8192, **kw) -> Model:
    """Fit on a bounded sample of the labelled rows of ``docs``, the same for every run: whole texts of any
    length, whose distinct words are together at most ``max_rows`` * ``max_bytes`` bytes per class (at
    least one text)."""
    marks = labels.groupBy(id_col).agg(F.max(label_col).alias("y")).filter("y is not null")
    some = docs.select(id_col, F.octet_length("text").alias("size")).filter("size > 0").select(id_col).distinct()
    marked = some.join(marks, id_col).select(F.col(id_col).alias("id"), F.col("y").cast("int").alias("y"))
    lists = word_lists(docs.filter(F.octet_length("text") > 0), marked, id_col, max_rows)
    sizes = lists.select("id", "y", "size").orderBy(F.xxhash64("id"), "id").collect()  # at most 2 * max_rows
    ids = []
    for y in (0, 1):
        own, room = [r for r in sizes if r.y == y], max_rows * max_bytes
        taken = []
        for r in own:
            if r.size <= room:
                taken.append(r.id)
                room -= r.size
        ids += taken or [r.id for r in sorted(own, key=lambda r: r.size)[:1]]
    if not ids:
        return fit([], np.zeros(0, np.int64), **kw)
    wanted = docs.sparkSession.createDataFrame([(i,) for i in ids], f"id {dict(docs.dtypes)[id_col]}")
    rows = lists.join(F.broadcast(wanted), "id").orderBy("y", "id").collect()
    return fit([bytes(r.words) for r in rows], np.array([r.y for r in rows], np.int64), **kw)


def score(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` plus score, the probability of the label for each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rows, data, offs in C.text_blocks(batches, text_col):
            p = np.zeros(rows.num_rows)
            if m.known:
                text, start, end, first = _layout(data, offs)
                z = pooled(word_logits(text, start, end, m), first) if len(start) else np.full(len(p), -np.inf)
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                p[np.isneginf(z)] = 0.0
            yield pa.RecordBatch.from_arrays([*(rows.column(rows.schema.get_field_index(c)) for c in id_cols), pa.array(p)],
                                             [*id_cols, "score"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in id_cols), "score double"])
    return docs.select(*dict.fromkeys([*id_cols, text_col])).mapInArrow(run, schema)
