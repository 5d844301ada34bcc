"""Registered queries against plain loops over the same tables."""

import math

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.test_dedup import roots
from vexa.llm import common as C
from vexa.llm import queries, toxicity


def plain_score(text, m):
    """Score of a whole text, word by word and n-gram by n-gram."""
    z = []
    for word in bytes(C.LOWER_AZ[np.frombuffer((text or "").encode(), np.uint8)]).split():
        framed = b" " + word + b" "
        whole = int(C.RollingHash(np.frombuffer(word, np.uint8)).ranges(np.array([0]), np.array([len(word)]))[0])
        weights = [float(m.weight[whole % m.buckets])]
        for n in toxicity.GRAMS:
            for i in range(len(framed) - n + 1):
                gram = C.RollingHash(np.frombuffer(framed[i:i + n], np.uint8)).windows(n)
                weights.append(float(m.weight[int(gram[0]) % m.buckets]))
        z.append(sum(weights) / len(weights) + m.bias)
    if not z:
        return 0.0
    top = max(z)
    pooled = top + math.log(sum(math.exp(toxicity.SHARP * (x - top)) for x in z)) / toxicity.SHARP
    return 1 / (1 + math.exp(-pooled))


def test_op1_scores_whole_texts(spark):
    docs = C.load(spark, SF, "documents").select("doc_id", "text")
    model = toxicity.train(docs.filter(queries.part(4) != 2), C.load(spark, SF, "labels"))
    got = {r.doc_id: r for r in queries.QUERIES["op1_toxicity"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert model.known and set(got) == set(texts)
    some = sorted(texts, key=lambda i: len(texts[i] or ""))
    for i in some[:60] + [i for i in texts if got[i].predicted][:20]:
        want = plain_score(texts[i], model)
        assert abs(got[i].score - want) < 1e-6
        assert got[i].predicted == (got[i].score >= 0.3)


def test_op8_on_embeddings(spark):
    rows = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect())
    x = np.array([v for _, v in rows], np.float64)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    root = roots(len(rows), list(zip(*np.nonzero(near))))
    ids = [i for i, _ in rows]
    want = {(ids[k], int(near[k].sum()), ids[root[k]], root[k] == k) for k in range(len(ids))}
    assert {tuple(r) for r in queries.QUERIES["op8_embedding_dedup"](spark, SF).collect()} == want


def test_op8_links_of_near_copies_at_the_registered_settings(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 32))
    x = np.concatenate([base + s * rng.normal(size=base.shape) for s in (0.0, 0.2, 0.4, 0.5)] + [base[:5]])
    df = C.identified(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), "vec_id", "embedding")
    from vexa.llm import embedding
    got = {r._uid: (r.n_links, r.component) for r in embedding.near_vectors(df).collect()}
    u = x / np.sqrt((x * x).sum(axis=1))[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    root = roots(len(x), list(zip(*np.nonzero(near))))
    missed = sum(got[i][0] != int(near[i].sum()) for i in range(len(x)))
    assert 0 < near.sum() and missed <= 1 and sum(got[i][1] != root[i] for i in range(len(x))) <= 4


def test_op11_and_op13_on_the_same_rows_as_the_tables(spark):
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    anchors = queries.QUERIES["op11_hard_negatives"](spark, SF)
    assert anchors.select("anchor_id").distinct().count() <= n / 50 + 1
    assert anchors.filter((F.col("rank") < 1) | (F.col("rank") > 3)).count() == 0
