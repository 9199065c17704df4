"""Toxicity, language and search: held-out accuracy and brute force."""

import collections
import math
import os
import random

import numpy as np
import pytest

from opsledger.llm import decontaminate, language, search, toxicity

FOLDER = "/root/testdata/sf0.01"
there = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def invented(seed, n, toxic_share=0.3):
    """Texts of common words; toxic ones hold some words of a small list or its inflected stems."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"{r.choice('bcdfg')}{r.choice('aeiou')}{r.choice('lmnr')}{r.randrange(60)}x" for _ in range(40)]
        words = ["".join(chr(97 + ord(c) % 26) if c.isdigit() else c for c in w) for w in words]
        toxic = r.random() < toxic_share
        for _ in range(r.randrange(1, 5) if toxic else 0):
            words.insert(r.randrange(40), r.choice(["zumpel", "krott", "qualig" + r.choice("abcdefgh")]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = invented(1, 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None), (10 ** 9, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    vectors = toxicity.Vectors(model.terms)
    held = [(model.score(vectors, t)[0], y) for i, t, y in rows if __import__("zlib").crc32(str(i).encode()) % 4 == 2]
    right = sum((s >= toxicity.THRESHOLD) == bool(y) for s, y in held)
    assert len(held) > 150 and right >= 0.97 * len(held)
    assert model.score(vectors, None)[0] == model.score(vectors, "")[0] < toxicity.THRESHOLD


def test_toxicity_without_labels(spark, messy, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.accepted(messy, labels)
    assert got.columns == messy.columns and got.count() == messy.count()
    assert toxicity.accepted(nothing, labels).count() == 0
    clean = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int")
    assert toxicity.accepted(messy, clean).count() == messy.count()


def test_block_max_index_equals_all_cosines():
    r = np.random.default_rng(1)
    dense = np.where(r.random((1000, 60)) < 0.08, r.random((1000, 60)), 0)
    dense /= np.maximum(np.sqrt((dense ** 2).sum(1, keepdims=True)), 1e-12)
    dense[500:520] = dense[0]  # ties
    vectors = [(np.flatnonzero(v), v[v > 0]) for v in dense]
    index = toxicity.BlockMaxIndex(vectors, 60, block=32)
    for q in range(0, 1000, 37):
        cosines = np.round(dense @ dense[q], 12)
        order = [x for x in np.lexsort((np.arange(1000), -cosines))[:15] if cosines[x] > 0]
        rows, values = index.nearest(*vectors[q], 15)
        assert np.allclose(values, cosines[order])
        assert set(rows) == set(order) or np.isclose(cosines[order][-1], values[-1])


@there
def test_toxicity_on_the_test_tables(spark):
    got = {r.doc_id: r for r in toxicity.op2_toxicity(spark, FOLDER).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [i for i in labels if got[i].held_out]
    hits = sum(got[i].predicted and labels[i] for i in held)
    assert hits >= 0.6 * sum(labels[i] for i in held)           # recall and precision of toxic rows; most rows are clean
    assert hits >= 0.7 * sum(got[i].predicted for i in held)
    assert all(0 <= r.score <= 1 for r in got.values())


@there
def test_language_on_the_test_tables(spark):
    got = {r.doc_id: r for r in language.op6_language(spark, FOLDER).collect()}
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    held = [i for i in known if got[i].held_out]
    assert sum(got[i].lang_pred == known[i] for i in held) >= 0.97 * len(held)


def test_language_cases(spark, messy, nothing):
    model = language.fit(messy.select("doc_id", "text", "lang"))
    assert model.languages == ["en"]
    assert model.predict(None) == model.predict("") == model.predict("12 - 3!") == ("und", 0.0)
    assert model.predict("é")[0] == "en"
    none = language.fit(nothing.select("doc_id", "text", "lang"))
    assert none.predict("some text") == ("und", 0.0)
    assert messy.select(language.predicted(messy["text"], model, spark).alias("p")).count() == messy.count()


def test_every_language_is_learned(spark):
    """200 languages of ten rows each, told apart by their letters."""
    r = random.Random(8)

    def text(i):
        letters = [chr(0x4E00 + 3 * i + j) for j in range(3)]
        return " ".join("".join(r.choices(letters, k=4)) for _ in range(12))

    rows = [(10 * i + k, text(i), f"l{i:03d}") for i in range(200) for k in range(10)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 200
    assert sum(model.predict(text(i))[0] == f"l{i:03d}" for i in range(200)) >= 190


def best(docs, text, k=10):
    """BM25 of every document, in plain Python."""
    bags = [(i, collections.Counter(decontaminate.words(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    df = collections.Counter(w for _, b in bags for w in b)
    mean = sum(b.total() for _, b in bags) / len(bags)
    found = []
    for i, b in bags:
        score = sum(
            n * math.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * b.total() / mean))
            for w, n in collections.Counter(decontaminate.words(text)).items() if w in b)
        if score > 0:
            found.append((-score, (1 << 63) if i is None else i))
    return sorted(found)[:k]


def same(rows, want):
    got = sorted((r.rank, (1 << 63) if r.doc_id is None else r.doc_id, r.score) for r in rows)
    assert [g[1] for g in got] == [w[1] for w in want]
    assert np.allclose([g[2] for g in got], [-w[0] for w in want])


def test_search_equals_all_scores(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_PAIRS", 60)  # several blocks of queries
    r = random.Random(9)
    docs = [(i, " ".join(r.choice("abcdefgh") * r.randrange(1, 5) for _ in range(r.randrange(0, 60)))) for i in range(700)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    docs += [(900 + i, f"rare{i} rare{i // 2}") for i in range(6)]  # words that stand in few documents only
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    queries = [*[(i, docs[i][1]) for i in range(0, 700, 50)], (700, "rare1 rare2 rare3"), (701, "rare5")]
    rows = search.search(frame, spark.createDataFrame(queries, "query_id long, text string"), k=7).collect()
    for q, text in queries:
        same([x for x in rows if x.query_id == q], best(docs, text, 7))


def test_search_cases(spark, messy, nothing):
    queries = spark.createDataFrame([(1, "one two w7"), (2, None), (3, ""), (4, "absent"), (5, "no id here"), (None, "one")],
                                    "query_id long, text string")
    rows = search.search(messy, queries).collect()
    docs = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    assert {r.query_id for r in rows} == {1, 5}
    for q, text in ((1, "one two w7"), (5, "no id here")):
        same([x for x in rows if x.query_id == q], best(docs, text))
    assert search.search(nothing, queries).count() == 0
    assert search.search(messy, queries.limit(0)).count() == 0


def test_the_fitted_model_reaches_the_driver_part_by_part(spark, monkeypatch):
    r = random.Random(31)
    docs = spark.createDataFrame([(i, " ".join(r.choice("abcdefgh") * r.randrange(1, 5) for _ in range(20)) + " vile" * (i % 3 == 0)) for i in range(60)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    want, terms = toxicity.fitted(docs, labels)
    asked, collect = [], type(docs).collect

    def counted(frame):
        rows = collect(frame)
        asked.append(sum(len(row.data) for row in rows if "data" in row))
        return rows

    monkeypatch.setattr(toxicity, "PART_BYTES", 1000)
    monkeypatch.setattr(type(docs), "collect", counted)
    got, same_terms = toxicity.fitted(docs, labels)
    assert 0 < max(asked) <= 1000 < max(x.nbytes for x in got.values())
    assert same_terms == terms and got.keys() == want.keys() and all(np.array_equal(got[n], want[n]) for n in want)


def test_search_of_many_shards_and_batches_puts_equal_documents_in_order_of_ids(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_WORDS", 1500)
    monkeypatch.setattr(search, "COMMON", 6)
    r = random.Random(21)
    texts = [" ".join(f"w{int(r.paretovariate(0.6)) % 900}" for _ in range(r.randrange(5, 60))) for _ in range(60)]
    docs = [(i * 7 % 601, texts[i % 60]) for i in range(601)]  # ten copies of each, dealt over the shards
    queries = [(i, texts[i % 60] + f" w{i}") for i in range(300)]
    rows = search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                         spark.createDataFrame(queries, "query_id long, text string"), k=8).collect()
    bags = [(i, collections.Counter(decontaminate.words(t))) for i, t in docs]
    df = collections.Counter(w for _, b in bags for w in b)
    mean = sum(b.total() for _, b in bags) / len(bags)
    idf = {w: math.log(1 + (len(bags) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    for q, text in queries[::7]:
        asked = collections.Counter(decontaminate.words(text))
        found = [(i, sum(n * idf[w] * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * b.total() / mean)) for w, n in asked.items() if w in b))
                 for i, b in bags]
        want = sorted((-round(score, 9), i) for i, score in found if score > 0)[:8]
        got = sorted((x.rank, x.doc_id, x.score) for x in rows if x.query_id == q)
        assert [g[1] for g in got] == [w[1] for w in want]
        assert np.allclose([g[2] for g in got], [-w[0] for w in want])


def test_search_meets_the_table_of_common_words_once_a_batch():
    r = random.Random(22)
    words = [np.array([r.randrange(1, 120) for _ in range(80)], np.uint64) for _ in range(500)]
    shard = search.Shard(search.build_shard(list(range(500)), words), 80.0)
    met = []

    class Counted(np.ndarray):
        def __array_ufunc__(self, ufunc, method, *inputs, **kwargs):
            if ufunc is np.matmul:
                met.append(inputs[0].shape)
            return getattr(ufunc, method)(*[np.asarray(x) for x in inputs], **kwargs)

    shard.table = shard.table.view(Counted)
    terms = [np.unique(w) for w in words[:300]]
    asked = search.Queries(np.arange(300), np.append(0, np.cumsum([len(t) for t in terms])),
                           np.concatenate(terms).view(np.int64), np.ones(sum(map(len, terms))))
    best = [(np.zeros(0), np.zeros(0, np.int64))] * 300
    shard.search(asked, 5, best)
    assert [b[1][0] for b in best] == list(range(300))
    assert [n for n, _ in met] == [search.BATCH, 300 - search.BATCH]


def near_copies(docs, ids):
    """Copies of the documents in which every tenth word is another one."""
    texts = {r.doc_id: r.text for r in docs.where(docs["doc_id"].isin(ids)).collect()}
    return [" ".join(f"other{n}x" if n % 10 == 9 else w for n, w in enumerate(texts[i].split())) for i in ids]


@there
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_near_copies_of_toxic_examples_at_every_size(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"/root/testdata/{size}/labels.parquet")
    model = toxicity.fit(docs, labels)
    vectors = toxicity.Vectors(model.terms)
    for label in (1, 0):
        ids = [int(i) for i, t in zip(model.ids, model.toxic, strict=True) if t == label][:60]
        found = [s >= toxicity.THRESHOLD for s, _ in model.scores(vectors, near_copies(docs, ids))]
        assert sum(found) >= 0.95 * len(found) if label else sum(found) <= 0.1 * len(found)


def test_examples_are_compared_without_terms_of_the_label(spark):
    rows = invented(4, 60, 0.0)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], int(r[0] % 9 == 0)) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert not model.terms[1]
    toxic = [int(i) for i, t in zip(model.ids, model.toxic, strict=True) if t]
    scores = model.scores(toxicity.Vectors(model.terms), [*near_copies(docs, toxic), "words of none"])
    assert all(s >= toxicity.THRESHOLD and e[0] == i for (s, e), i in zip(scores, toxic, strict=False))
    assert scores[-1][0] < toxicity.THRESHOLD


def test_word_index_equals_all_cosines():
    r = np.random.default_rng(2)
    dense = np.where(r.random((700, 90)) < 0.1, r.random((700, 90)), 0).astype(np.float32).astype(float)
    dense[:, :5] = r.random((700, 5)).astype(np.float32)
    dense[500:520] = dense[0]  # ties
    dense /= 4
    vectors = [(np.flatnonzero(v), v[v > 0]) for v in dense]
    index = toxicity.WordIndex(vectors, 90, common=6)
    asked = list(range(0, 700, 37))
    for q, (rows, values) in zip(asked, index.nearest([vectors[q] for q in asked], 15), strict=True):
        cosines = np.round(dense @ dense[q], 12)
        order = [x for x in np.lexsort((np.arange(700), -cosines))[:15] if cosines[x] > 0]
        assert np.allclose(values, np.minimum(cosines[order], 1))
        assert set(rows) == set(order) or np.isclose(cosines[order][-1], values[-1])


def test_of_repeated_queries_the_smallest_text_is_asked(spark):
    docs = [(i, w) for i, w in enumerate(["alpha", "beta", "gamma", "delta"])]
    queries = [(1, t) for t in ("gamma", "delta", None, "beta", "alpha")]
    rows = search.search(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(queries, "query_id long, text string").coalesce(1)).collect()
    assert [r.doc_id for r in rows] == [0]


def test_words_are_those_of_the_pattern():
    r = random.Random(14)
    signs = ["a", "B", "é", "½", "²", "٣", "—", "_", " ", "字", "7", "İ", "ß", "\u0301", "\u212a", "Ⅷ", "\x1c", "\x85", "🙂", "ª", "\n"]
    for _ in range(2000):
        text = "".join(r.choices(signs, k=r.randrange(15)))
        assert toxicity.words_of(text) == toxicity._WORD.findall(text.lower())
    assert toxicity.words_of(None) == []


def test_known_words_are_looked_up_once(monkeypatch):
    asked = []
    hashes = toxicity.hashes
    monkeypatch.setattr(toxicity, "hashes", lambda words, n: asked.append(n) or hashes(words, n))
    known = np.sort(hashes(["one", "two", "krott"], 3))
    vectors = toxicity.Vectors((known, {"kro": 0, "krott$": 1}))
    bags = [toxicity.bag_of(t) for t in ("One two two krott", None, "kroll other one")]
    first, again = vectors.found(bags), vectors.found(bags)
    assert sum(asked) == 6 and first[1] == again[1] == [{0: 1, 1: 1}, {}, {0: 1}]
    for found in (first[0], again[0]):
        assert [sorted(zip(known[ids].tolist(), n.tolist(), strict=True)) for ids, n in found] == [
            sorted((int(hashes([w], 1)[0]), n) for w, n in bag.items() if hashes([w], 1)[0] in known) for bag in bags]


def test_terms_are_counted_in_bounded_parts(spark, monkeypatch):
    rows = invented(15, 200)
    known = spark.createDataFrame([(r[2], r[1]) for r in rows], "toxic int, text string").coalesce(1)
    toxic = sum(r[2] for r in rows)
    want = toxicity.choose_terms(known, toxic, 200 - toxic)
    monkeypatch.setattr(toxicity, "COUNTED_TERMS", 300)
    assert want and toxicity.choose_terms(known, toxic, 200 - toxic) == want
