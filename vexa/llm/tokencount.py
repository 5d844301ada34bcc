"""Token counts by count-only Viterbi over a unigram vocabulary (operator 2).

An Aho-Corasick automaton over the vocabulary lists the pieces that end at each
character; dynamic programming keeps, per character, the best score and the number of
tokens of the best segmentation, and no segmentation itself.  The rules are those of the
public unigram tokenizers: scores add up in double precision; a piece ending at a
character replaces the best one only if its score is strictly higher, and pieces are tried by
their start, earliest first; a character without a one-character piece may be an unknown token, 10
below the worst score; neighbouring unknown characters are fused, and with byte fallback
count one token per byte.

No piece has a space mark after another character, so the best segmentation of a text is
made of those of its chunks (space marks followed by other characters), and
each distinct chunk of a task is solved once.  ``Vocabulary`` checks this and falls back to whole
texts where a piece spans chunks.

Null and empty texts have no tokens.  Repeated rows count alike.  Other columns are
ignored.  The vocabulary file is read on the driver from a path that the caller gives; the
vocabulary is broadcast (its size is fixed by the file).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 1 << 18  # distinct chunks remembered by a task


class Vocabulary:
    """Pieces and scores of a unigram model, with its conventions."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool, space_prefix: bool = True):
        self.scores = dict(pieces)
        self.byte_fallback = byte_fallback
        self.space_prefix = space_prefix
        self.unknown = (min(self.scores.values()) if self.scores else 0.0) - UNKNOWN_PENALTY
        self.chunked = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.scores)

    @classmethod
    def from_sentencepiece(cls, path: str) -> "Vocabulary":
        """Ordinary pieces of a SentencePiece model file, read on the driver."""
        import sentencepiece

        with open(path, "rb") as f:
            sp = sentencepiece.SentencePieceProcessor(model_proto=f.read())
        ids = range(sp.get_piece_size())
        plain = [(sp.id_to_piece(i), sp.get_score(i)) for i in ids
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        return cls(plain, any(sp.is_byte(i) for i in ids))


class Counter:
    """Counts tokens of texts; built once per task."""

    def __init__(self, vocab: Vocabulary):
        import ahocorasick

        self.vocab = vocab
        self.auto = ahocorasick.Automaton()
        for piece, score in vocab.scores.items():
            self.auto.add_word(piece, (len(piece), score))
        self.auto.make_automaton()
        self.chunk = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.cache: dict[str, int] = {}

    def solve(self, s: str) -> int:
        """Tokens of the best segmentation of one chunk."""
        n = len(s)
        vocab = self.vocab
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        single = bytearray(n)
        if vocab.scores:
            for last, (size, score) in self.auto.iter(s):
                ends[last + 1].append((size, score))
                if size == 1:
                    single[last] = 1
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        tail = [False] * (n + 1)  # the best segmentation ends in an unknown run
        for i in range(1, n + 1):
            top, tokens, unknown = None, 0, False
            options = ends[i]
            if len(options) > 1:
                options.sort(reverse=True)  # earliest start first
            for size, score in options:
                value = best[i - size] + score
                if top is None or value > top:
                    top, tokens, unknown = value, count[i - size] + 1, False
            if not single[i - 1]:
                value = best[i - 1] + vocab.unknown
                if top is None or value > top:
                    if vocab.byte_fallback:
                        more = len(s[i - 1].encode("utf-8", "surrogatepass"))
                    else:
                        more = 0 if tail[i - 1] else 1
                    top, tokens, unknown = value, count[i - 1] + more, True
            best[i], count[i], tail[i] = top, tokens, unknown
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        s = text.replace(" ", SPACE)
        if self.vocab.space_prefix:
            s = SPACE + s
        if not self.vocab.chunked or not self.vocab.byte_fallback:
            return self.solve(s)  # unknown runs may cross chunks
        cache, total = self.cache, 0
        for c in self.chunk.findall(s):
            n = cache.get(c)
            if n is None:
                n = self.solve(c)
                if len(cache) >= CACHE:
                    cache.clear()
                if len(c) <= 64:
                    cache[c] = n
            total += n
        return total


def token_counts(docs: DataFrame, vocab: Vocabulary, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` plus n_tokens of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col))
            n = [counter.count(t.as_py() or "") for t in texts]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in id_cols), pa.array(n, pa.int64())],
                                             [*id_cols, "n_tokens"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in id_cols), "n_tokens long"])
    return docs.select(*dict.fromkeys([*id_cols, text_col])).mapInArrow(run, schema)
