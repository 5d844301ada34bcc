"""Quality by weak labels (operator 3).

Nine heuristic labellers vote good, bad or nothing on each text.  Expectation
maximisation estimates how each of them votes on good and on bad texts from the counts
of vote patterns over all documents (at most 3**9 numbers, whatever the corpus), and gives every
pattern a posterior.  The posteriors label a bounded sample of whole texts of any length, on which a linear scorer
over hashed byte n-grams and hashed levels of the labellers' measures is trained; its score decides.  No human label is used.
Where all texts are likely good, or all likely bad, no scorer can be trained and the posterior is the score.

A text without words gets no vote, has score 0 and is rejected.  Repeated rows score
alike, and a row without an id counts like any other.  Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.llm import common as C
from vexa.llm.minhash import WORD_BYTE

#: (feature, good up to, bad from); a feature between them gets no vote.  The labellers overlap:
#: every common defect is seen by two or more of them.
LABELLERS = (
    ("symbols", 0.02, 0.06),       # signs other than sentence marks, by byte
    ("odd words", 0.05, 0.20),     # words with such a sign, a bar or an exclamation mark
    ("capitals", 0.08, 0.25),      # words with two capitals after a letter
    ("shouts", 0.02, 0.10),        # exclamation marks by word
    ("stutter", 0.04, 0.12),       # words equal to the word before, but for one
    ("sameness", 0.65, 0.85),      # 1 - distinct words among at most 100 neighbours
    ("bars", 0.01, 0.10),          # | by word
    ("digits", 0.15, 0.35),        # digits by byte
    ("long words", 10.0, 16.0),    # mean bytes of a word
)
GRAMS = (1, 2, 3)
LEVEL = 0.2   # value of a level feature beside n-gram shares
SHORT = 30.0  # n-grams without evidence added to every text, so that a few words prove little

_SENTENCE = np.zeros(256, bool)
_SENTENCE[[ord(c) for c in ".,;:!?'\"()-|"]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_KIND = np.zeros((256, 6), bool)
_KIND[:, 0] = ~_ALNUM & ~_SENTENCE & WORD_BYTE
_KIND[0x41:0x5B, 1] = True
_KIND[0x41:0x5B, 2] = _KIND[0x61:0x7B, 2] = True
_KIND[ord("!"), 3] = True
_KIND[ord("|"), 4] = True
_KIND[0x30:0x3A, 5] = True


def _sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(flags)])
    return (run[offs[1:]] - run[offs[:-1]]).astype(np.float64)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """([text, labeller] values, words per text)."""
    n = np.maximum(np.diff(offs), 1)
    start, end, first = C.word_spans(WORD_BYTE[data], offs)
    words = np.diff(first)
    w = np.maximum(words, 1)
    flags = [_KIND[:, k][data] for k in range(6)]
    flags[1][1:] &= flags[2][:-1]  # a capital counts after a letter only
    flags[1][:1] = False
    kinds = [_sums(f, offs) for f in flags]
    odd = np.concatenate([[0], np.cumsum(flags[0] | flags[3] | flags[4])])
    odd = odd[end] > odd[start]
    loud = np.concatenate([[0], np.cumsum(flags[1])])
    loud = loud[end] >= loud[start] + 2
    h = C.RollingHash(C.LOWER_AZ[data]).ranges(start, end)
    owner = np.repeat(np.arange(len(words)), words)
    stutter = np.zeros(len(h), bool)
    stutter[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    # repeats among neighbours: chunks of 100 words of one text
    place = (np.arange(len(h)) - first[:-1][owner]) // 100
    order = np.lexsort((h, place, owner))
    again = np.zeros(len(h), bool)
    o, p = order[1:], order[:-1]
    again[1:] = (h[o] == h[p]) & (place[o] == place[p]) & (owner[o] == owner[p])
    again = np.bincount(owner[order][again], minlength=len(words)) if len(h) else np.zeros(len(words))
    cols = [kinds[0] / n, _sums(odd, first) / w, _sums(loud, first) / w, kinds[3] / w,
            np.maximum(_sums(stutter, first) - 1, 0) / w,
            again / w, kinds[4] / w, kinds[5] / n, _sums(end - start, first) / w]
    return np.stack(cols, 1), words


def votes(feat: np.ndarray, words: np.ndarray) -> np.ndarray:
    """[text, labeller]: 0 no vote, 1 good, 2 bad.  Texts without words get no vote."""
    low = np.array([a for _, a, _ in LABELLERS])
    high = np.array([b for _, _, b in LABELLERS])
    v = np.where(feat <= low, 1, np.where(feat >= high, 2, 0))
    v[words == 0] = 0
    return v


def patterns(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


@dataclass
class WeakLabels:
    """Naive mixture: P(good) and P(vote | quality) for every labeller."""

    prior: float
    table: np.ndarray  # [labeller, quality (0 bad, 1 good), vote]

    def posterior(self, v: np.ndarray) -> np.ndarray:
        z = np.full(len(v), np.log(self.prior / (1 - self.prior)))
        for k in range(v.shape[1]):
            odds = np.log(self.table[k, 1] / self.table[k, 0])
            odds[0] = 0.0  # an abstention says nothing
            z += odds[v[:, k]]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def estimate(pattern: np.ndarray, count: np.ndarray, rounds: int = 50) -> WeakLabels:
    """Expectation maximisation over counted vote patterns.

    Starts from the belief that one vote of "bad" outweighs the others' silence or
    praise, since each labeller looks for a defect of its own."""
    k = len(LABELLERS)
    v = (pattern[:, None] // 3 ** np.arange(k)) % 3
    bad = (v == 2).sum(axis=1)
    q = np.where(bad > 0, 0.1, 0.9)
    weight = count / max(count.sum(), 1)
    model = WeakLabels(0.5, np.full((k, 2, 3), 1 / 3))
    for _ in range(rounds):
        prior = float(np.clip((weight * q).sum(), 0.01, 0.99))
        table = np.empty((k, 2, 3))
        for y, p in ((0, 1 - q), (1, q)):
            for j in range(k):
                table[j, y] = np.bincount(v[:, j], weight * p, 3) + 1e-4
        # a labeller is taken to be better than chance
        table /= table.sum(axis=2, keepdims=True)
        table[:, 0, 2] = np.maximum(table[:, 0, 2], 1.5 * table[:, 1, 2])
        table /= table.sum(axis=2, keepdims=True)
        model = WeakLabels(prior, table)
        q = model.posterior(v)
    return model


def _keyed(docs: DataFrame, id_col: str) -> DataFrame:
    """(key, text): the key is a hash of id and text, so a row without an id has one, and copies share theirs."""
    return docs.select(F.xxhash64(id_col, "text").alias("key"), "text")


def vote_table(docs: DataFrame, id_col: str) -> DataFrame:
    """(key, pattern) of every text with words, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in C.text_blocks(batches):
            feat, words = features(data, offs)
            some = pa.array(words > 0)
            yield pa.RecordBatch.from_arrays(
                [c.filter(some) for c in (rows.column(0), pa.array(patterns(votes(feat, words))))], ["key", "pattern"])

    return C.save(_keyed(docs, id_col).mapInArrow(run, "key long, pattern long"), "votes")


@dataclass
class Scorer:
    weight: np.ndarray  # by n-gram bucket
    bias: float
    known: bool

    def scores(self, data: np.ndarray, offs: np.ndarray, feat: np.ndarray) -> np.ndarray:
        z = np.zeros(len(offs) - 1)
        total = np.full(len(offs) - 1, SHORT)
        for g, h in enumerate(_grams(data, len(self.weight))):
            run = np.concatenate([[0.0], np.cumsum(self.weight[h], dtype=np.float64)])
            n = np.maximum(np.diff(offs) - GRAMS[g] + 1, 0)
            lo = np.minimum(offs[:-1], len(h))
            z += np.where(n > 0, run[np.minimum(lo + n, len(h))] - run[lo], 0.0)
            total += n
        z = z / total + LEVEL * self.weight[_levels(feat, len(self.weight))].sum(axis=1) + self.bias
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return np.where(np.diff(offs) > 0, p, 0.0)


def _grams(data: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    roll = C.RollingHash(data)
    for n in GRAMS:
        yield (roll.windows(n) % np.uint64(buckets)).astype(np.int64)


def _levels(feat: np.ndarray, buckets: int) -> np.ndarray:
    """[text, labeller]: bucket of the level of each labeller's value."""
    out = np.empty(feat.shape, np.uint64)
    for k, (_, low, high) in enumerate(LABELLERS):
        out[:, k] = 8 * k + np.digitize(feat[:, k], [low / 2, low, (low + high) / 2, high, 1.5 * high])
    return (C.mix(out + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def shares(text: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, value) of the n-gram shares and levels of a whole text: at most ``buckets`` and nine numbers."""
    data = np.frombuffer(text, np.uint8)
    count = np.zeros(buckets, np.int64)
    for g in _grams(data, buckets):
        count += np.bincount(g, minlength=buckets)
    b = np.flatnonzero(count)
    level = _levels(features(data, np.array([0, len(data)]))[0], buckets)[0]
    return (np.concatenate([b, level]).astype(np.int32),
            np.concatenate([count[b] / (count.sum() + SHORT), np.full(len(level), LEVEL)]).astype(np.float32))


def fit_scorer(cols: list[np.ndarray], vals: list[np.ndarray], q: np.ndarray, buckets: int = 1 << 14, steps: int = 200,
               rate: float = 0.5, decay: float = 1e-4, at_once: int = 128) -> Scorer:
    """Logistic regression on the ``shares`` of texts against posterior labels, by Adam.
    Each step adds up the gradient over portions of ``at_once`` texts."""
    if not len(q) or (q >= 0.5).all() or (q < 0.5).all():
        return Scorer(np.zeros(buckets), 0.0, False)
    at = np.concatenate([[0], np.cumsum([len(c) for c in cols])])
    col, val = np.concatenate(cols), np.concatenate(vals)
    cols.clear(), vals.clear()  # the driver's memory is small
    w, bias, m, v = np.zeros(buckets), 0.0, np.zeros(buckets + 1), np.zeros(buckets + 1)
    share = max(min(q.mean(), 1 - 1e-6), 1e-6)
    balance = (q * 0.5 / share + (1 - q) * 0.5 / (1 - share)) / len(q)
    for step in range(1, steps + 1):
        g = np.append(decay * w / len(q), 0.0)
        for lo in range(0, len(q), at_once):
            hi = min(lo + at_once, len(q))
            c, x = col[at[lo]:at[hi]], val[at[lo]:at[hi]]
            z = np.add.reduceat(w[c] * x, at[lo:hi] - at[lo]) + bias
            err = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - q[lo:hi]) * balance[lo:hi]
            g[:-1] += np.bincount(c, np.repeat(err, np.diff(at[lo:hi + 1])) * x, buckets)
            g[-1] += err.sum()
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-10)
        w, bias = w - move[:-1], bias - move[-1]
    return Scorer(w, float(bias), True)


def sampled_shares(docs: DataFrame, chosen: DataFrame, id_col: str, buckets: int) -> DataFrame:
    """(key, pattern, cols, vals, n) of the whole texts of the ``chosen`` (key, pattern), written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for rows, data, offs in C.text_blocks(batches):
            for i, (key, pattern) in enumerate(zip(rows.column(0).to_pylist(), rows.column(2).to_pylist())):
                if key in seen:
                    continue
                seen.add(key)  # at most the chosen ones
                c, v = shares(data[offs[i]:offs[i + 1]].tobytes(), buckets)
                yield pa.RecordBatch.from_pylist([{"key": key, "pattern": pattern, "cols": c.tobytes(), "vals": v.tobytes(), "n": len(c)}])

    found = _keyed(docs, id_col).join(F.broadcast(chosen), "key").select("key", "text", "pattern")
    one = found.mapInArrow(run, "key long, pattern long, cols binary, vals binary, n long").groupBy("key").agg(
        F.min(F.struct("pattern", "cols", "vals", "n")).alias("s"))
    return C.save(one.select("key", "s.*"), "shares")


def train(docs: DataFrame, id_col: str = "doc_id", max_rows: int = 1500, max_numbers: int = 1 << 22,
          buckets: int = 1 << 14) -> tuple[WeakLabels, Scorer]:
    """Weak labels from all documents; the scorer from at most ``max_rows`` whole texts of either likely
    class, of any length, the first by hash whose shares are together at most ``max_numbers``
    numbers (at least one text)."""
    table = vote_table(docs, id_col)
    rows = table.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()  # at most 3**9
    pattern, count = np.array([r.pattern for r in rows], np.int64), np.array([r.n for r in rows], np.float64)
    model = estimate(pattern, count)
    every = (pattern[:, None] // 3 ** np.arange(len(LABELLERS))) % 3
    q = model.posterior(every)
    if not len(q) or (q >= 0.5).all() or (q < 0.5).all():
        return model, fit_scorer([], [], np.zeros(0), buckets)
    chosen = None
    for side in (q >= 0.5, q < 0.5):
        likely = docs.sparkSession.createDataFrame([(int(p),) for p in pattern[side]], "pattern long")
        first = table.join(F.broadcast(likely), "pattern").select("key", "pattern").distinct().orderBy("key").limit(max_rows)
        chosen = first if chosen is None else chosen.unionByName(first)
    sample = sampled_shares(docs, chosen, id_col, buckets)
    post = dict(zip(pattern.tolist(), q.tolist()))
    keys: dict[bool, list[int]] = {}
    total = {True: 0, False: 0}
    for r in sample.select("key", "pattern", "n").orderBy("key").collect():  # at most 2 * max_rows
        good = post[r.pattern] >= 0.5
        total[good] += r.n
        if not keys.setdefault(good, []) or total[good] <= max_numbers:
            keys[good].append(r.key)
    last = {good: max(k) for good, k in keys.items()}
    cols, vals, own = [], [], []
    for good, top in last.items():
        likely = docs.sparkSession.createDataFrame([(p,) for p, v in post.items() if (v >= 0.5) == good], "pattern long")
        part = sample.filter(F.col("key") <= top).join(F.broadcast(likely), "pattern").orderBy("key")
        for r in part.select("pattern", "cols", "vals").collect():  # at most max_numbers
            cols.append(np.frombuffer(r.cols, np.int32))
            vals.append(np.frombuffer(r.vals, np.float32))
            own.append(post[r.pattern])
    return model, fit_scorer(cols, vals, np.array(own), buckets)


def score(docs: DataFrame, models: tuple[WeakLabels, Scorer], text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus _posterior (of the labellers) and _quality (the score);
    columns of these names that ``docs`` has already are replaced."""
    docs = docs.drop("_posterior", "_quality")
    shared = docs.sparkSession.sparkContext.broadcast(models)  # bounded by the number of buckets
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weak, scorer = shared.value
        for rows, data, offs in C.text_blocks(batches, text_col):
            feat, words = features(data, offs)
            q = np.where(words > 0, weak.posterior(votes(feat, words)), 0.0)
            p = np.where(words > 0, scorer.scores(data, offs, feat), 0.0) if scorer.known else q
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(q), pa.array(p)], [*names, "_posterior", "_quality"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_posterior", T.DoubleType()),
                           T.StructField("_quality", T.DoubleType())])
    return docs.mapInArrow(run, schema)
