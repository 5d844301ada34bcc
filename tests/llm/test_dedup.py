"""Near duplicates, repeated passages, decontamination and embeddings against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.conftest import SF
from vexa.llm import common as C
from vexa.llm import components, embedding, minhash, posindex, queries, suffix

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingles(t, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near_rows():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    base = list(rng.choice(words, 120))
    rows = [" ".join(base)]
    for k in range(40):  # straddles the threshold
        t = list(base)
        for i in rng.integers(0, 120, 1 + k % 5):
            t[i] = f"new{k}{i}"
        rows.append(" ".join(t))
    rows += [rows[0]] * 5 + ["one two", "ONE\ttwo", "one two three four five", "", None, " \n", "x" * 5000]
    rows += [" ".join(rng.choice(words, 60)) for _ in range(10)]
    return rows


def brute_near(texts, percent=85):
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return sets, roots(len(texts), pairs)


@pytest.mark.parametrize("block_bytes", [1 << 20, 6000])
def test_near_duplicates_equal_brute_force(spark, block_bytes):
    texts = near_rows()
    docs = spark.createDataFrame([(i, t, None, "s", None) for i, t in enumerate(texts)], DOCS)
    sets, root = brute_near(texts)
    got = {r._uid: r for r in minhash.near_duplicates(C.identified(docs), block_bytes=block_bytes).collect()}
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert (got[i].n_shingles, got[i].component, got[i].kept) == (len(sets[i]), root[i], root[i] == i)


def test_near_duplicates_at_the_similarity_of_the_pipeline(spark):
    from corpus_pipeline import NEAR, drop_near_duplicates

    texts = near_rows()
    docs = spark.createDataFrame([(i, t, None, "s", None) for i, t in enumerate(texts)], DOCS)
    _, root = brute_near(texts, 100 * NEAR[0] // NEAR[1])
    assert root != brute_near(texts)[1]
    kept = {r.doc_id for r in drop_near_duplicates(spark, docs, SF).collect()}
    assert kept == {i for i in range(len(texts)) if root[i] == i}
    assert (minhash.least_matches(48, (85, 100)), minhash.least_matches(48, NEAR)) == (28, 24)


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


@pytest.mark.parametrize("n", [64, 128, 1024, 2048, 4096])
def test_words_that_a_polynomial_hash_confuses_are_different(spark, n):
    x, y = thue_morse(n), thue_morse(n, "b", "a")
    raw = np.frombuffer((x + " " + y + " " + x).encode(), np.uint8)
    h = C.word_hashes(raw, np.array([0, n + 1, 2 * n + 2]), np.array([n, 2 * n + 1, 3 * n + 2]))
    assert h[0] != h[1] and h[0] == h[2]
    docs = C.identified(spark.createDataFrame([(1, x), (2, y), (3, x)], "doc_id long, text string"))
    assert {r._uid: r.component for r in minhash.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}
    bench = spark.createDataFrame([(7, x)], "item_id long, text string")
    assert {r._uid: r.n_hit for r in posindex.contamination(docs, bench).collect()} == {1: 1, 2: 0, 3: 1}


def test_unrelated_sets_share_no_coordinate(spark):
    docs = spark.range(6000).selectExpr("id AS _uid", "array_join(transform(sequence(0, 150), x -> md5(concat(id, '-', x))), ' ') AS text")
    sigs = minhash.signatures(docs, 5, 48)
    keys = minhash._postings(sigs, 48)
    assert keys.count() == 6000 * 48 == keys.select("key").distinct().count()


def test_families_larger_than_a_block_equal_brute_force(spark):
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(400)]
    texts = []
    shared = " ".join(rng.choice(words, 30))
    for f in range(3):
        base = list(rng.choice(words, 90))
        for k in range(70):  # a family that drifts: its ends are alike through its middle only
            base[int(rng.integers(90))] = f"f{f}k{k}"
            texts.append(shared + " " + " ".join(base))
    order = rng.permutation(len(texts))
    texts = [texts[i] for i in order]
    docs = C.identified(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    _, root = brute_near(texts)
    units = []
    full = minhash._compared

    def counted(placed, part, *args, crossing):
        units.append((crossing, placed.count()))
        return full(placed, part, *args, crossing=crossing)

    minhash._compared = counted
    try:
        got = {r._uid: r.component for r in minhash.near_duplicates(docs, block_bytes=8000).collect()}
    finally:
        minhash._compared = full
    assert got == dict(enumerate(root))
    assert units[0] == (False, len(texts)) and units[-1][0]
    # copies with one changed word: one family of many blocks ends without any row compared across blocks
    near = [" ".join(["x%d" % i if j == i else w for j, w in enumerate(words[:200])]) for i in range(150)]
    docs = C.identified(spark.createDataFrame(list(enumerate(near)), "doc_id long, text string"))
    units.clear()
    minhash._compared = counted
    try:
        got = {r.component for r in minhash.near_duplicates(docs, block_bytes=8000).collect()}
    finally:
        minhash._compared = full
    assert got == {0} and units[-1] == (True, 0)


def test_ids_that_are_no_integers(spark):
    rows = [("b", "a b c d e f g"), ("a", "a b c d e f g"), ("c", "other words altogether here now")]
    docs = C.identified(spark.createDataFrame(rows, "doc_id string, text string"))
    got = {r.doc_id: r.kept for r in minhash.near_duplicates(docs).join(docs, "_uid").collect()}
    assert got == {"a": True, "b": False, "c": True}


def test_op7_on_documents(spark):
    rows = queries.QUERIES["op7_minhash_dedup"](spark, SF).collect()
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    sets, root = brute_near([t for _, t in docs])
    ids = [d for d, _ in docs]
    expect = {(ids[i], len(sets[i]), ids[root[i]], root[i] == i) for i in range(len(ids))}
    assert {tuple(r) for r in rows} == expect and len(rows) == len(ids)


def test_repeated_and_null_ids_are_rows_of_their_own(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "a b c d e f g"), (2, None), (2, "z"), (None, None)]
    docs = C.identified(spark.createDataFrame(rows, "doc_id long, text string"))
    assert docs.select("_uid").distinct().count() == 6
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == 6 and sum(not r.kept for r in got) == 2
    report = suffix.removal_report(docs).collect()
    assert len(report) == 6


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 80, (60, 2))] + [(i, i + 1) for i in range(100, 160)]
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    want = roots(200, pairs)
    assert got == {x: want[x] for p in pairs if p[0] != p[1] for x in p}
    empty = spark.createDataFrame([], "a long, b long")
    assert components.connected_components(empty, "a", "b").count() == 0


def test_repeat_classes_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(300):
        length, letters = int(rng.integers(3, 30)), int(rng.integers(1, 6))
        base = rng.integers(97, 97 + letters, 200).astype(np.uint8)
        parts = []
        for _ in range(int(rng.integers(1, 12))):
            a = int(rng.integers(0, 150))
            parts.append(np.concatenate([rng.integers(97, 97 + letters, rng.integers(0, 20)), base[a:a + rng.integers(0, 60)],
                                         rng.integers(97, 97 + letters, rng.integers(0, 20))]).astype(np.uint8))
        parts = [p for p in parts if len(p)] or [base]
        seen = {}
        for i, x in enumerate(parts):
            for k in range(len(x) - length + 1):
                seen.setdefault(x[k:k + length].tobytes(), []).append((i, k))
        want = {(*p, p == min(v)) for v in seen.values() if len(v) > 1 for p in v}
        assert set(zip(*(a.tolist() for a in suffix.repeated_windows(parts, length)))) == want


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for uid, raw in sorted(rows):
        cover = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if raw[k:k + length] in seen:
                cover[k:k + length] = True
            seen.add(raw[k:k + length])
        kept = bytes(np.frombuffer(raw, np.uint8)[~cover])
        out[uid] = (len(raw), int(cover.sum()), int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum()),
                    hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("block", [suffix.BLOCK, 3000])
def test_repeated_passages_equal_brute_force(spark, block):
    rng = np.random.default_rng(4)

    def prose(n):
        return "".join(rng.choice(list("abcdé fgh"), n))

    passage = prose(400)
    texts = [prose(int(rng.integers(0, 150))) + passage[int(rng.integers(0, 200)):int(rng.integers(250, 400))]
             + prose(int(rng.integers(0, 150))) for _ in range(60)]
    texts += [texts[0], texts[0], "ab" * 300, "ab" * 120, "", None, "x" * 99, "x" * 100, "x" * 101, prose(70000)]
    docs = C.identified(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    want = brute_repeats([(i, (t or "").encode()) for i, t in enumerate(texts)])
    spans = suffix.repeated_spans(docs, block=block).collect()
    got = {r._uid: tuple(r)[1:] for r in suffix.removal_report(docs).collect()}
    assert got == want
    for r in spans:
        cover = {b for s in r.spans for b in range(s.start, s.stop)}
        assert len(cover) == want[r._uid][1]
    trimmed = {r._uid: r.text for r in suffix.trimmed_texts(docs).collect()}
    assert len(trimmed) == len(texts) and "�" not in "".join(trimmed.values())


def test_op9_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = brute_repeats([(r.doc_id, (r.text or "").encode()) for r in docs])
    assert {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op9_suffix_dedup"](spark, SF).collect()} == want


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(docs, items, width=13):
    windows = {}
    for name, t in items:
        w = WORD.findall(low(t))
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + width]), set()).add(name)
    out = {}
    for uid, t in docs:
        w, hit, found = WORD.findall(low(t)), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[k:k + n]))):
                    hit |= set(range(k, k + n))
                    found |= names
        out[uid] = (len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("windows", [100_000, 30])
def test_phrases_equal_brute_force(spark, windows):
    rng = np.random.default_rng(6)
    vocab = ["the", "a", "of", "Ünder", "x1", "cat", "dog", "sun"]
    texts = [" ".join(rng.choice(vocab, int(n))) for n in rng.integers(0, 400, 50)] + [None, "", "...", "the"]
    items = [("i%d" % k, texts[k][10:130]) for k in range(12)] + [("one", "x1 cat dog"), ("same", "x1 cat dog"), ("none", ""),
                                                                   ("null", None), ("solo", "sun")]
    docs = C.identified(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id string, text string")
    index = posindex.build_index(docs, block_bytes=2000)
    got = {r._uid: (sum(e - s for s, e in zip(r.starts, r.ends)), sorted(set(r["items"])))
           for r in posindex.phrase_matches(index, bench, windows=windows).collect()}
    for uid, (_, n_hit, names, _) in brute_hits(list(enumerate(texts)), items).items():
        assert got.get(uid, (0, [])) == (n_hit, names)


def test_proximity_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    vocab = [f"t{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocab, 80)) for _ in range(20)]
    docs = C.identified(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    index = posindex.build_index(docs, block_bytes=700)
    freq = {v: sum(t.split().count(v) for t in texts) for v in vocab}
    query = ["t3", "t7", "t11"]
    rare = min(query, key=lambda v: freq[v])
    if list(freq[q] for q in query).count(freq[rare]) > 1:
        pytest.skip("tie for the rarest term")
    want = set()
    for d, t in enumerate(texts):
        w = t.split()
        for p in range(len(w)):
            near = w[max(0, p - 6):p + 7]
            if w[p] == rare and all(q in near for q in query):
                want.add((d, "q", p))
    items = spark.createDataFrame([("q", " ".join(query))], "item_id string, text string")
    assert {tuple(r) for r in posindex.proximity_matches(index, items, slop=6).collect()} == want


def test_op10_on_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute_hits(docs, items)
    for r in queries.QUERIES["op10_decontaminate"](spark, SF).collect():
        n, hit, names, bad = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(names), bad)
        assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()


def test_no_items_and_no_documents(spark):
    docs = C.identified(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:3] for r in posindex.contamination(docs, none).collect()] == [(2, 0)]
    empty = C.identified(spark.createDataFrame([], DOCS))
    assert posindex.contamination(empty, none).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert suffix.removal_report(empty).count() == 0


@pytest.mark.parametrize("block_rows", [2048, 40])
def test_vectors_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(6, 16))
    rows = [(centre[i % 6] + rng.normal(scale=0.25, size=16)).tolist() for i in range(200)]
    rows += [rows[0]] * 7 + [[2 * x for x in rows[1]], [0.0] * 16, None, [], [float("nan")] * 16, [float("inf")] + [0.0] * 15,
                             [1e300] * 16, [1.0] * 15]
    rows.append([None] + [1.0] * 15)
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                           T.StructField("label", T.IntegerType())])
    df = C.identified(spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], schema), "vec_id", "embedding")
    good = [i for i, v in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    pairs, count = [], [0] * len(rows)
    for i in good:
        for j in good:
            if i != j and len(rows[i]) == len(rows[j]):
                a, b = (np.array(rows[k]) / np.abs(rows[k]).max() for k in (i, j))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9:
                    pairs.append((i, j))
                    count[i] += 1
    root = roots(len(rows), pairs)
    got = {r._uid: r for r in embedding.near_vectors(df, block_rows=block_rows, recall=0.999999).collect()}
    assert len(got) == len(rows)
    assert [got[i].n_links for i in range(len(rows))] == count
    assert [got[i].component for i in range(len(rows))] == root


def test_copies_of_a_benchmark_item_are_collected_once(spark):
    items = spark.createDataFrame([("a", "one two three " * 20)] * 500 + [("b", "four"), (None, None)], "item_id string, text string")
    chunks = posindex._chunked_items(items, "item_id", 13, 1000)
    assert len(chunks) == 1
    assert sorted(tuple(r) for c in chunks for r in c.collect()) == [("a", "one two three " * 20), ("b", "four"), ("null", "")]


@pytest.mark.parametrize("width", [13, 64])
def test_windows_of_a_very_long_item_fit_a_small_driver(spark, width):
    import pickle
    import tracemalloc

    rng = np.random.default_rng(width)
    text = " ".join(f"w{x}" for x in rng.integers(0, 50_000, 1_300_000))  # 8 MB
    bench = spark.createDataFrame([(1, text), (2, "short one")], "item_id long, text string")
    chunks = posindex._chunked_items(bench, "item_id", width, posindex.CHUNK_WINDOWS if width == 13 else posindex.CHUNK_WINDOWS // 4)
    index = posindex.build_index(C.identified(spark.createDataFrame([(1, text[:5000])], "doc_id long, text string")))
    largest = max(chunks, key=lambda c: c.count())
    tracemalloc.start()
    w = posindex._ranked(index, largest, width)
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()
    assert len(pickle.dumps(w)) < 100e6 and len(w.terms) > 1000
    # every window of the item is in some piece
    words = text.split()
    pieces = [r.text.split() for c in chunks for r in c.collect() if r.name == "1"]
    assert len(pieces) > 3 and sum(len(p) - width + 1 for p in pieces) == len(words) - width + 1


def test_a_passage_from_the_middle_of_a_cut_item_is_found(spark):
    words = [f"v{i}" for i in range(500)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = C.identified(spark.createDataFrame([(k, "x " + " ".join(words[k:k + 13]) + " y") for k in range(0, 480)], "doc_id long, text string"))
    found = posindex.phrase_matches(posindex.build_index(docs), bench, windows=40).collect()
    assert {r._uid: (r.starts, r.ends) for r in found} == {k: ([1], [14]) for k in range(480)}


def test_a_family_posts_its_keys_once_per_block(spark):
    """2,000 near copies share 46 of 48 keys; a second part holds 40 of them."""
    common = np.arange(1000, 1046)
    rows = [(i, 0, 0, np.concatenate([common, [10**6 + 2 * i, 10**6 + 2 * i + 1]])) for i in range(2000)]
    rows += [(5000 + i, 0, 5000, np.concatenate([common[:40], np.arange(8) + 9000])) for i in range(3)]
    rows += [(6000, 1, 6000, common), (6001, 1, 6000, common)]  # one part alone
    rows += [(7000, 2, 7000, np.arange(48)), (7001, 2, 7001, np.concatenate([np.arange(20), np.arange(28) + 500]))]
    df = spark.createDataFrame([(u, c, p, bytearray(k.astype("<i8").tobytes())) for u, c, p, k in rows],
                               "_uid long, cluster long, part long, keys binary")

    def held(least):
        return {r._uid for r in minhash._held_elsewhere(df, least).collect()}

    family = set(range(2000)) | {5000, 5001, 5002}
    assert held(28) == held(40) == family
    assert held(1) == held(20) == family | {7000, 7001}
    assert held(41) == set()
    blocks = df.selectExpr("*", "pmod(xxhash64(_uid), 4) AS block")
    posted = minhash._block_keys(blocks)
    assert posted.count() < 48 * 2007 / 10
    low = {(r.cluster, r.key): (r.low, r.high) for r in posted.groupBy("cluster", "key").agg({"low": "min", "high": "max"})
           .withColumnsRenamed({"min(low)": "low", "max(high)": "high"}).collect()}
    assert low[0, 1000] == (0, 5000) and low[0, 1045] == (0, 0) and low[0, 9000] == (5000, 5000) and low[2, 3] == (7000, 7001)
