"""Language spans by Viterbi decoding of per-word scores (operator 4).

Words are maximal runs of letters.  The script of a word narrows the candidates to the
languages whose training text uses that script; a hashed letter-trigram model
of each language scores the word.  Over the words of a text, the best sequence of languages is
the one of highest total score, where each change of language costs ``penalty``.

The model is a table of counts, added up over all training documents; only
(languages x ``buckets``) numbers reach the driver.  The languages are the distinct
values of ``lang``, a short list by nature.

Null and empty texts and texts without a letter are ``und`` with score 0 and no spans.  A
text whose letters belong to scripts never seen in training gets the most common
language with score 0.  Ties between languages go to the first by name.  Repeated rows
are labelled alike.  Other columns pass through untouched.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexa.llm import common as C

TOP = 0x32000  # letters above are none in practice
UNKNOWN = "und"


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(lower case or 0 for non-letters, script number, script names) by code point.

    A letter's script is the first word of its Unicode name (LATIN, GREEK, CJK ...),
    which is constant over ranges of code points."""
    low, script, names = np.zeros(TOP, np.uint32), np.zeros(TOP, np.int16), {"": 0}
    for c in range(TOP):
        ch = chr(c)
        if ch.isalpha():
            small = ch.lower()
            low[c] = ord(small) if len(small) == 1 else c
            name = unicodedata.name(ch, "OTHER").split()[0]
            script[c] = names.setdefault(name, len(names))
    return low, script, list(names)


def code_points(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a block of UTF-8 texts and the offsets of the texts."""
    order = "utf-32-le" if sys.byteorder == "little" else "utf-32-be"
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode(order, "replace"), np.uint32)
    if len(cp) == lead[-1]:
        return cp, lead[offs]
    raw = data.tobytes()  # malformed bytes: decode text by text
    each = [np.frombuffer(raw[a:b].decode("utf-8", "replace").encode(order, "replace"), np.uint32)
            for a, b in zip(offs[:-1], offs[1:])]
    return np.concatenate(each), np.concatenate([[0], np.cumsum([len(e) for e in each])])


@dataclass
class Words:
    start: np.ndarray    # code-point bounds in the block
    end: np.ndarray
    first: np.ndarray    # first word of each text
    script: np.ndarray   # of each word
    bucket: np.ndarray   # of each letter's trigram
    letter_at: np.ndarray  # first letter of each word in ``bucket``
    offs: np.ndarray


def words_of(data: np.ndarray, offs: np.ndarray, buckets: int) -> Words:
    low, script, _ = _tables()
    cp, at = code_points(data, offs)
    known = cp < TOP
    small = np.where(known, low[np.minimum(cp, TOP - 1)], 0)
    start, end, first = C.word_spans(small > 0, at)
    inside = np.flatnonzero(small > 0)
    size = end - start
    letter_at = np.cumsum(size) - size
    mid = small[inside].astype(np.uint64)
    left = np.concatenate([[0], mid[:-1]]).astype(np.uint64)
    right = np.concatenate([mid[1:], [0]]).astype(np.uint64)
    left[letter_at] = 0
    right[letter_at + size - 1] = 0
    bucket = (C.mix((left << np.uint64(42)) | (mid << np.uint64(21)) | right) % np.uint64(buckets)).astype(np.int32)
    return Words(start, end, first, script[np.minimum(cp[start], TOP - 1)] if len(start) else start, bucket, letter_at, at)


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray     # [language, bucket]
    allowed: np.ndarray  # [script, language]
    common: int          # most common language
    buckets: int
    penalty: float


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = 1 << 15,
          penalty: float = 12.0, alpha: float = 0.5, script_share: float = 0.001) -> Model:
    """Count letter trigrams and scripts per language over all rows of ``docs``."""
    n_scripts = len(_tables()[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for rows, data, offs in C.text_blocks(batches, text_col, C.BLOCK_BYTES):
            w = words_of(data, offs, buckets)
            lang = rows.column(rows.schema.get_field_index(lang_col)).dictionary_encode()
            code = lang.indices.to_numpy(zero_copy_only=False)
            names = lang.dictionary.to_pylist()
            who = np.repeat(code, np.diff(w.first))
            per_letter = np.repeat(who, w.end - w.start)
            for k, name in enumerate(names):
                add = np.concatenate([np.bincount(w.bucket[per_letter == k], minlength=buckets),
                                      np.bincount(w.script[who == k], minlength=n_scripts)])
                total[name] = total.get(name, 0) + add
        for name, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some), pa.array(n[some])],
                                             ["lang", "slot", "n"])

    used = docs.filter(F.col(lang_col).isNotNull()).select(text_col, lang_col)
    counts = used.mapInArrow(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    table = counts.toPandas()  # languages x (buckets + scripts) at most
    langs = sorted(table["lang"].unique())
    full = np.zeros((len(langs), buckets + n_scripts))
    full[np.searchsorted(langs, table["lang"]) if langs else [], table["slot"].to_numpy(np.int64)] = table["n"]
    n, scripts = full[:, :buckets], full[:, buckets:].T
    logp = np.log((n + alpha) / (n.sum(axis=1, keepdims=True) + alpha * buckets))
    share = scripts / np.maximum(scripts.sum(axis=0, keepdims=True), 1)
    return Model(langs, logp.astype(np.float32), share >= script_share,
                 int(n.sum(axis=1).argmax()) if langs else -1, buckets, penalty)


def viterbi(score: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label per word of every text; texts advance together, word by word."""
    n_lang = score.shape[1]
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), side="left")  # texts with more than t words
    back = np.zeros(score.shape, np.int8 if n_lang < 128 else np.int32)
    own = np.arange(n_lang)
    state = np.zeros((len(size), n_lang))
    for t in range(steps):
        a = active[t]
        rows = begin[:a] + t
        s = state[:a]
        if t:
            best = s.argmax(axis=1)
            top = s[np.arange(a), best] - penalty
            stay = s >= top[:, None]
            back[rows] = np.where(stay, own, best[:, None])
            s = np.maximum(s, top[:, None])
        state[:a] = s + score[rows]
    label = np.zeros(len(score), np.int64)
    now = np.zeros(len(size), np.int64)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        fresh = slice(active[t + 1] if t + 1 < steps else 0, a)  # texts whose last word this is
        now[fresh] = state[fresh].argmax(axis=1)
        rows = begin[:a] + t
        label[rows] = now[:a]
        now[:a] = back[rows, now[:a]]
    return label


def _scored(w: Words, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """([word, language] scores, whether any language uses the word's script)."""
    score = np.empty((len(w.start), len(m.langs)))
    for k in range(len(m.langs)):
        score[:, k] = np.add.reduceat(m.logp[k][w.bucket], w.letter_at)
    allowed = m.allowed[w.script]
    known = allowed.any(axis=1)
    score[~allowed] = -1e6
    score[~known] = 0.0
    return score, known


def predict(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` plus lang_pred, score (share of the text's letters in that language)
    and the spans (code-point starts and ends, languages) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in id_cols), "lang_pred string", "score double",
                        "starts array<int>", "ends array<int>", "langs array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = pa.array([*m.langs, UNKNOWN], pa.string())
        unknown = len(m.langs)
        for rows, data, offs in C.text_blocks(batches, text_col, C.BLOCK_BYTES):
            w = words_of(data, offs, m.buckets)
            n = rows.num_rows
            owner = np.repeat(np.arange(n), np.diff(w.first))
            pred, share = np.full(n, unknown), np.zeros(n)
            label = np.full(len(w.start), unknown)
            if len(w.start) and m.langs:
                score, known = _scored(w, m)
                label = np.where(known, viterbi(score, w.first, m.penalty), unknown)
                size = w.end - w.start
                letters = np.zeros((n, unknown + 1))
                np.add.at(letters, (owner, label), size)
                some = letters.sum(axis=1) > 0
                pred[some] = letters[some, :unknown].argmax(axis=1)
                share[some] = letters[some, pred[some]] / letters[some].sum(axis=1)
                lost = some & (share == 0)
                pred[lost] = m.common
            new = np.ones(len(label), bool)
            new[1:] = (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(label)) - 1 if len(at) else at
            cut = pa.array(np.searchsorted(owner[at], np.arange(n + 1)).astype(np.int32))
            base = w.offs[owner[at]]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(rows.schema.get_field_index(c)) for c in id_cols), names.take(pa.array(pred)), pa.array(share),
                 pa.ListArray.from_arrays(cut, pa.array((w.start[at] - base).astype(np.int32))),
                 pa.ListArray.from_arrays(cut, pa.array((w.end[last] - base).astype(np.int32))),
                 pa.ListArray.from_arrays(cut, names.take(pa.array(label[at])))],
                [*id_cols, "lang_pred", "score", "starts", "ends", "langs"])

    return docs.select(*dict.fromkeys([*id_cols, text_col])).mapInArrow(run, schema)
