import random
import re
import tracemalloc

from pyspark.sql import functions as F

from opsledger.llm import jaccard, shingles as hashed
from opsledger.llm.components import components


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    n = min(width, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def brute(docs, width, num, den):
    """doc_id -> smallest doc_id reachable."""
    sets = [(i, shingles(t, width)) for i, t in docs if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def random_docs(seed, n=160):
    """Edited copies of a few texts, some of them chained so that links hold only along the chain."""
    r, docs = random.Random(seed), []
    base = [[f"v{r.randrange(300)}" for _ in range(r.choice([6, 40, 90]))] for _ in range(5)]
    for i in range(n):
        text = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            text[r.randrange(len(text))] = f"n{r.randrange(10 ** 6)}"
        docs.append((i * 7 % 997, " ".join(text)))
        if r.random() < 0.2:
            base.append(text)
    return docs


def test_components_equal_all_pairs(spark):
    docs = [*random_docs(1), *[(2000 + i, t) for i, t in random_docs(2, 60)]]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for width, num, den in ((4, 85, 100), (5, 80, 100), (2, 60, 100)):
        got = {r.doc_id: r for r in jaccard.linked(frame, width, num, den).collect()}
        want = brute(docs, width, num, den)
        assert {i: r.component_id for i, r in got.items()} == want
        assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingles(t, width)) for i, t in docs}


def test_messy_rows(messy, nothing):
    rows = jaccard.linked(messy).collect()
    assert len(rows) == messy.count()
    docs = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    want = brute(docs, 4, 85, 100)
    assert all(r.component_id == (None if r.doc_id is None else want[r.doc_id]) for r in rows)
    assert jaccard.linked(nothing).count() == 0
    kept = jaccard.one_of_each(messy, 5, 80, 100)
    assert kept.columns == messy.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} >= {None, 1, 4, 5, 6, 7, 8, 9, 11, 12}
    assert not {r.doc_id for r in kept.select("doc_id").collect()} & {2, 3, 10}


def test_one_id_with_two_texts_is_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    frame = spark.createDataFrame([(5, a), (5, b), (3, b), (9, a), (4, "other text stands alone here")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in jaccard.linked(frame).collect()} == {(5, 3), (3, 3), (9, 3), (4, 4)}


def test_components_of_paths_stars_and_cycles(spark):
    path = [(i, i + 1) for i in range(100, 400)]
    star = [(1000, 1000 + i) for i in range(1, 500)]
    cycle = [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    far = [(-5, 2 ** 62), (7, 7), (None, 1)]
    edges = spark.createDataFrame([*path, *star, *cycle, *far], "a long, b long").orderBy(F.rand(3)).repartition(7)
    got = {r.node: r.root for r in components(edges).collect()}
    want = {i: 100 for i in range(100, 401)} | {1000 + i: 1000 for i in range(500)} | {2000 + i: 2000 for i in range(50)}
    assert got == want | {-5: -5, 2 ** 62: -5}
    assert components(edges.limit(0)).count() == 0


def test_shingles_of_many_texts_take_memory_of_a_piece():
    r = random.Random(21)
    texts = [" ".join(str(r.randrange(3000)) for _ in range(200)) for _ in range(1000)]
    alone = [hashed.shingle_sets([t], 4)[0] for t in texts[:20]]
    tracemalloc.start()
    found = hashed.shingle_sets(texts, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((a == b).all() for a, b in zip(alone, found, strict=False))
    assert peak < sum(f.nbytes for f in found) + (16 << 20)
