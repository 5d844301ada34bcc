"""Scorers, token counts, packing, archives and the pipeline."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from vexa.llm import langid, packing, quality, queries, tokencount, toxicity, warc
from vexa.session import scratch_path

TOKENIZER = queries.UNIGRAM_FILE
ODD = [(1, "plain words here"), (2, None), (3, ""), (4, " \n\t"), (None, "no id"), (1, "plain words here"), (5, "é" * 3000),
       (6, "\U0001F600 漢字 ok")]


def odd(spark):
    return spark.createDataFrame([(i, t, "en", 0.5) for i, t in ODD], "doc_id long, text string, lang string, score double")


def toxic_corpus(seed, n=400):
    rng = np.random.default_rng(seed)
    plain = ["".join(rng.choice(list("aeioutnrsl"), rng.integers(2, 8))) for _ in range(300)]
    bad = ["grumbol", "vexator", "snarkit"]
    texts, y = [], []
    for i in range(n):
        w = list(rng.choice(plain, rng.integers(5, 200)))
        y.append(i % 4 == 0)
        if y[-1]:
            w[int(rng.integers(len(w)))] = str(rng.choice(bad))
        texts.append(" ".join(w))
    return texts, np.array(y, np.int64)


def toxic_scores(model, texts):
    raw = [t.encode() for t in texts]
    text, start, end, first = toxicity._layout(np.frombuffer(b"".join(raw), np.uint8),
                                               np.concatenate([[0], np.cumsum([len(t) for t in raw])]))
    return 1 / (1 + np.exp(-toxicity.pooled(toxicity.word_logits(text, start, end, model), first)))


def test_toxicity_held_out_and_misspelled():
    texts, y = toxic_corpus(1)
    model = toxicity.fit([t.encode() for t in texts[:300]], y[:300], steps=80)
    p = toxic_scores(model, texts[300:])
    assert ((p >= 0.3) == y[300:]).mean() >= 0.98
    clean, wrong = toxic_scores(model, ["neto rasti lone", "neto rasti grummbol lone"])
    assert wrong > 10 * clean


def test_toxicity_of_odd_rows(spark):
    texts, y = toxic_corpus(2, 80)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)] + [(0, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, steps=5)
    got = toxicity.score(odd(spark).withColumnRenamed("score", "score_"), model, ["doc_id"]).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert [r.score for r in got][1:4] == [0.0, 0.0, 0.0] and got[0].score == got[5].score
    untrained = toxicity.train(docs, labels.filter("toxic = 5"))
    assert {r.score for r in toxicity.score(docs, untrained, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).count() == 0


def test_op1_columns(spark):
    rows = queries.QUERIES["op1_toxicity"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3)


def test_op4_held_out_accuracy(spark):
    rows = queries.QUERIES["op4_language_spans"](spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(50):
        sizes = rng.integers(0, 6, 4)
        first = np.concatenate([[0], np.cumsum(sizes)])
        score = rng.normal(size=(int(first[-1]), 3)) * 3
        label = langid.viterbi(score, first, 2.0)
        for a, b in zip(first[:-1], first[1:]):
            def total(path):
                return sum(score[a + i, k] for i, k in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))
            best = max((total(p) for p in itertools.product(range(3), repeat=int(b - a))), default=0)
            assert total(label[a:b].tolist()) == pytest.approx(best)


def test_language_spans_of_mixed_and_odd_text(spark):
    train = spark.createDataFrame([("the cat and the dog were there then", "en"), ("der hund und die katze sind nicht hier", "de"),
                                   ("кошка и собака здесь", "ru"), ("x", None)] * 5, "text string, lang string")
    model = langid.train(train, penalty=4.0)
    assert model.langs == ["de", "en", "ru"]
    mixed = "the dog and the cat were there кошка здесь и собака"
    rows = [(1, mixed), (2, None), (3, ""), (4, "123 !?"), (5, "漢字"), (None, "der hund"), (1, mixed)]
    got = langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model, ["doc_id"]).collect()
    assert [r.lang_pred for r in got] == ["en", "und", "und", "und", model.langs[model.common], "de", "en"]
    assert got[0].langs == ["en", "ru"] and mixed[got[0].starts[1]:got[0].ends[1]] == "кошка здесь и собака"
    assert [r.score for r in got][1:5] == [0.0] * 4 and all(0 <= r.score <= 1 for r in got)
    nothing = langid.train(train.limit(0))
    assert {r.lang_pred for r in langid.predict(train.withColumn("k", F.lit(1)), nothing, ["k"]).collect()} == {"und"}


def test_token_counts_equal_the_public_tokenizer(spark):
    from tokenizers import Tokenizer, models

    vocab = tokencount.Vocabulary.from_sentencepiece(TOKENIZER)
    plain = list(vocab.scores.items())
    raw = [(f"<0x{b:02X}>", vocab.unknown - 1e6) for b in range(256)]
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    texts += ["", "  a  b", "漢字かな\U0001F600x", "a▁b", "\t\n x", "ççç", "\U0001F600\U0001F601 a", "a" * 3000]
    for fallback in (True, False):
        known = [("<unk>", vocab.unknown + 10)] + plain + (raw if fallback else [])
        public = Tokenizer(models.Unigram(known, 0, fallback))
        counter = tokencount.Counter(tokencount.Vocabulary(plain, fallback))
        for t in texts:
            want = len(public.encode(tokencount.SPACE + t.replace(" ", tokencount.SPACE)).ids) if t else 0
            assert counter.count(t) == want


def test_token_counts_with_ties_and_odd_rows(spark):
    vocab = tokencount.Vocabulary([("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b▁a", -1.5), ("b", -4.0)], False)
    assert not vocab.chunked
    counter = tokencount.Counter(vocab)
    assert counter.count("aaa") == 2  # equal scores: the piece that starts earliest stays
    assert counter.count("zzz") == 2  # one space mark, one fused unknown
    got = tokencount.token_counts(odd(spark), vocab, ["doc_id"]).collect()
    assert len(got) == len(ODD) and got[1].n_tokens == got[2].n_tokens == 0


def test_quality_votes_estimates_and_scores(spark):
    good = [f"the river runs past house number {i} and on to the sea, where it ends quietly." for i in range(60)]
    bad = ["LOUD!! WORDS!! ONLY!! HERE!! %d" % i for i in range(12)] + ["x### y&&& z*** q$$$ %d###" % i for i in range(12)]
    bad += ["so " * 40 + str(i) for i in range(12)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)] + [(900, None), (901, ""), (None, good[0])],
                                 "doc_id long, text string")
    models = quality.train(docs)
    got = quality.score(docs, models).collect()
    assert len(got) == len(good) + len(bad) + 3
    kept = {r.doc_id for r in got if r._quality >= 0.5}
    assert kept == {*range(len(good)), None}
    empty = docs.limit(0)
    assert quality.score(empty, quality.train(empty)).count() == 0


def quality_texts():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("aeioutnrsl"), rng.integers(2, 9))) for _ in range(800)]
    clean = [" ".join(rng.choice(words, 2500)) + "." for _ in range(12)]
    junk = [" ".join("%s###!! BUY!! $$$" % w for w in rng.choice(words, 40)) for _ in range(12)]
    assert min(map(len, clean)) > 8192
    return clean, junk


def kept_texts(spark, texts, ids=None):
    docs = spark.createDataFrame([(None if ids is None else ids[i], t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.text for r in quality.score(docs, quality.train(docs)).collect() if r._quality >= 0.5}


def test_quality_of_long_texts_only(spark):
    clean, junk = quality_texts()
    long_junk = [t * 10 for t in junk]
    assert min(map(len, long_junk)) > 8192
    assert kept_texts(spark, clean + long_junk, range(24)) == set(clean)
    assert kept_texts(spark, clean, range(12)) == set(clean)


def test_quality_of_short_junk_and_long_clean_texts(spark):
    clean, junk = quality_texts()
    assert kept_texts(spark, clean + junk, range(24)) == set(clean)


def test_quality_without_ids(spark):
    clean, junk = quality_texts()
    assert kept_texts(spark, clean + junk) == set(clean)
    clean = [t[:400] for t in clean]
    assert kept_texts(spark, clean + junk) == set(clean)


def test_quality_sample_is_bounded_by_numbers(spark):
    clean, junk = quality_texts()
    docs = spark.createDataFrame(list(enumerate(clean + junk)), "doc_id long, text string")
    models = quality.train(docs, max_numbers=1)
    got = quality.score(docs, models).collect()
    assert models[1].known and {r.text for r in got if r._quality >= 0.5} == set(clean)


def test_em_recovers_accuracies():
    rng = np.random.default_rng(5)
    n, k = 20000, len(quality.LABELLERS)
    y = rng.random(n) < 0.8
    rate = np.linspace(0.3, 0.7, k)
    bad = np.where(y[:, None], rng.random((n, k)) < 0.02, rng.random((n, k)) < rate)
    pattern, count = np.unique(quality.patterns(np.where(bad, 2, 1)), return_counts=True)
    model = quality.estimate(pattern, count.astype(float))
    assert abs(model.prior - 0.8) < 0.03
    assert np.abs(model.table[:, 0, 2] - rate).max() < 0.05


def least_cost(sizes, caps, overhead):
    """Cheapest packing by trying every set partition."""
    best = [float("inf")]

    def place(i, bins):
        if i == len(sizes):
            best[0] = min(best[0], sum(min(c for c in caps if c >= b) + overhead for b in bins))
            return
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= max(caps):
                place(i + 1, bins[:j] + [bins[j] + sizes[i]] + bins[j + 1:])
        place(i + 1, bins + [sizes[i]])

    place(0, [])
    return best[0]


def test_packing_is_valid_and_near_the_least_cost():
    rng = np.random.default_rng(8)
    caps, overhead, ratios = (8, 16, 32), 1, []
    for _ in range(60):
        size = np.sort(rng.integers(0, 33, 7))[::-1]
        where, offset, capacity = packing.pack(size, caps, overhead)
        cost = 0
        for b in np.unique(where):
            m = np.flatnonzero(where == b)
            spans = sorted((offset[i], offset[i] + size[i]) for i in m)
            assert all(x[1] == y[0] for x, y in zip(spans, spans[1:])) and spans[0][0] == 0
            fill = size[m].sum()
            assert capacity[m[0]] == min(c for c in caps if c >= fill)
            cost += capacity[m[0]] + overhead
        ratios.append(cost / least_cost(size.tolist(), caps, overhead))
    assert max(ratios) <= 1.34 and np.mean(ratios) <= 1.05


def test_opened_size_is_that_of_least_cost_per_token():
    caps = np.array([8, 16, 32])
    # 5 + 3 fill 8 exactly; 16 and 32 would stay emptier
    assert packing._least_cost(0, -np.array([5, 3]), caps, 4) == 8
    # with many pieces to come the largest size spreads the overhead best
    assert packing._least_cost(0, -np.array([8] * 8), caps, 4) == 32
    # nothing fits behind it: the smallest size that holds it
    assert packing._least_cost(0, -np.array([9, 9]), caps, 0) == 16
    assert packing._least_cost(0, -np.array([0, 0]), caps, 4) == 8


def test_packing_covers_every_word(spark):
    rows = [(i, n) for i, n in enumerate([0, 1, 511, 512, 513, 4096, 4097, 20000, 7, 7])] + [(3, 512), (None, 9), (99, None), (98, -4)]
    got = packing.best_fit(spark.createDataFrame(rows, "doc_id long, n long"), "doc_id", "n", shard_pieces=5).collect()
    assert sum(r.size for r in got) == sum(max(n or 0, 0) for _, n in rows)
    fill = {}
    for r in got:
        fill.setdefault((r.bin, r.capacity), []).append((r.offset, r.offset + r.size))
    assert len({b for b, _ in fill}) == len(fill)
    for (_, capacity), spans in fill.items():
        spans.sort()
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= capacity
    assert packing.best_fit(spark.createDataFrame([], "doc_id long, n long"), "doc_id", "n").count() == 0


def test_op6_on_pages(spark):
    first, want = {}, set()
    for i, h in sorted((r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()):
        d = hashlib.sha256(h).hexdigest()
        f = first.setdefault(d, i)
        again = len(h) >= 100 and f != i
        want.add((i, len(h), d, "revisit" if again else "response", f if again else None))
    assert {tuple(r) for r in queries.QUERIES["op6_warc_archive"](spark, SF).collect()} == want


def test_archive_round_trip(spark):
    long = "é\r\n\r\n<p>" * 40
    rows = [(5, "u\r\nX: y", long, 1), (2, "v", long, 1), (None, "w", long, 1), (7, "u", "short", 1), (8, "u", "short", 1),
            (9, None, None, 1), (10, "", "", 1), (2, "z", long, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    path = warc.write(pages, scratch_path(spark, "t-warc"))
    got = warc.read(spark, path).collect()
    assert sorted(bytes(r.payload) for r in got) == sorted((h or "").encode() for _, _, h, _ in rows)
    seen = sorted((tuple(r) for r in warc.described(warc.read(spark, path)).collect()), key=str)
    kinds = [(r[0], r[3], r[4]) for r in seen if r[1] >= 100]
    assert sorted(kinds, key=str) == sorted([(2, "response", None), (2, "revisit", 2), (5, "revisit", 2), (None, "revisit", 2)], key=str)
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    out = scratch_path(spark, "t-files")
    warc.export(spark, path, out, file_bytes=600)
    back = warc.import_files(spark, out).collect()
    assert sorted(r.header for r in back) == sorted(r.header for r in got)
    assert sorted(bytes(r.block) for r in back if "revisit" not in r.header) == sorted(
        bytes(r.payload) for r in got if "WARC-Type: revisit" not in r.header)
    empty = warc.write(pages.limit(0), scratch_path(spark, "t-empty"))
    assert warc.read(spark, empty).count() == 0


def test_archive_of_repeated_rows_null_ids_and_forged_headers(spark):
    h = "x" * 200

    def archived(rows):
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        recs = warc.described(warc.read(spark, warc.write(pages, scratch_path(spark, "t-odd"))))
        return sorted(((r.page_id, r.record_type, r.refers_to) for r in recs.collect()), key=str)

    assert archived([(1, "u", h), (1, "u", h), (2, "u", h)]) == [(1, "response", None), (1, "revisit", 1), (2, "revisit", 1)]
    assert archived([(None, "u", h), (None, "u", h), (None, "v", h)]) == [(None, "response", None), (None, "revisit", None), (None, "revisit", None)]
    for end in "\u2028\u2029\u0085\r\n\x0b\x0c":
        assert archived([(5, f"u{end}WARC-Refers-To: <urn:page:77>", h)]) == [(5, "response", None)]
        assert archived([(5, f"u{end}WARC-Type: revisit", h), (6, "u", h)]) == [(5, "response", None), (6, "revisit", 5)]


def test_archive_of_a_hot_payload_moves_each_payload_once(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_RECORDS", 50)
    rows = [(i, f"u{i}", "hot" * 100 if i % 3 else f"{i} " * 100) for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    path = warc.write(pages, scratch_path(spark, "t-hot"))
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.described(warc.read(spark, path)).collect()}
    assert got == {i: ("response", None) if i % 3 == 0 or i == 1 else ("revisit", 1) for i in range(600)}
    assert spark.read.parquet(f"{path}/payloads").count() == 201


def test_pipeline(spark):
    import corpus_pipeline as P

    assert 4 <= len(P.STAGES) <= 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        path = scratch_path(spark, f"t-{name}")
        out.write.parquet(path)
        kept, before = spark.read.parquet(path), kept
        assert kept.count() <= before.count()
    words = kept.select(F.sum(queries.word_count(F.col("text")))).first()[0]
    assert P.STAGES[-1][1](spark, kept, SF).agg(F.sum("size")).first()[0] == words
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = P.STAGES[0][1](spark, docs, SF).join(labels, "doc_id")
    assert good.filter("quality = 0").count() <= 0.02 * labels.filter("quality = 0").count() + 1
    assert good.filter("quality = 1").count() >= 0.98 * labels.filter("quality = 1").count()


def test_pipeline_stages_take_odd_rows(spark):
    import corpus_pipeline as P

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clean = "a quiet river runs past the old mill and on to the sea where it ends in the evening light"
    rows = [(1, clean, None, None, None), (1, clean, None, None, None), (None, clean + " again", "en", None, 3), (2, None, None, None, None),
            (3, "", None, None, 0), (4, "word " * 20000, "en", "s", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() >= (1 if data else 0), name


def test_pipeline_stages_keep_columns_of_clashing_names(spark):
    import corpus_pipeline as P

    clean = "a quiet river runs past the old mill and on to the sea where it ends in the evening light"
    extra = ["_uid", "_quality", "kept", "n", "id", "_cut", "component", "other3", "items", "size"]
    rows = [(i, t, len(t), *range(i, i + len(extra))) for i, t in enumerate([clean, clean, clean.replace("river", "stream of water") + " glow"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, " + ", ".join(f"`{c}` long" for c in extra))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        for r in out.collect():
            assert tuple(r)[3:] == rows[r.doc_id][3:], name


def test_toxicity_learns_from_long_texts(spark):
    texts, y = toxic_corpus(3, 80)
    long = [(t + " ") * (1 + 9000 // len(t)) for t in texts]
    docs = spark.createDataFrame(list(enumerate(t if v == 0 else u for t, u, v in zip(texts, long, y))), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.known
    assert ((toxic_scores(model, texts) >= 0.3) == y).mean() >= 0.95
    assert toxicity.train(docs, labels, max_rows=40, max_bytes=1, steps=2).known
    raw = [t.encode() for t in texts[:20]]
    whole, lists = (toxicity.fit(r, y[:20], steps=3) for r in (raw, [toxicity.distinct_words(np.frombuffer(t, np.uint8)) for t in raw]))
    assert np.allclose(whole.weight, lists.weight) and np.isclose(whole.bias, lists.bias)


def test_packing_spreads_rows_without_or_with_one_id(spark):
    for hot in (None, 7):
        rows = [(hot, 100)] * 2000 + [(i, 100) for i in range(10, 1010)]
        got = packing.best_fit(spark.createDataFrame(rows, "doc_id long, n long"), "doc_id", "n", shard_pieces=100).collect()
        assert len(got) == len(rows)
        shard = np.unique([r.bin >> 32 for r in got], return_counts=True)[1]
        assert len(shard) == 30 and shard.max() < 200
