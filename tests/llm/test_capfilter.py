import math

import numpy as np
import pytest

from opsledger.llm import capfilter

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, least=0.95):
    """vec_id -> (n_links, component_id, kept), all pairs in double precision."""
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and None not in v
            and np.isfinite(v).all() and any(v)}
    ids = sorted(good)
    root, links = {i: i for i, _ in rows}, dict.fromkeys([i for i, _ in rows], 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = set()
    for k, a in enumerate(ids):
        x = good[a] / np.linalg.norm(good[a])
        for b in ids[:k]:
            y = good[b]
            if len(x) == len(y) and x @ y / np.linalg.norm(y) >= least:
                pairs.add((b, a))
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (links[i], find(i), find(i) == i) for i in links if i is not None}, pairs


def near(rng, x, cosine):
    """A vector at this cosine to x."""
    z = rng.normal(size=len(x))
    z -= z @ x / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + math.sqrt(1 - cosine * cosine) * z / np.linalg.norm(z)


def groups(seed, dimensions=64, sizes=(2, 3, 5, 40), singles=400, cosine=0.985):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dimensions) for _ in range(singles)]
    for n in sizes:
        centre = rng.normal(size=dimensions)
        out += [near(rng, centre, cosine) * rng.uniform(0.1, 9) for _ in range(n)]
    return [(i * 3, v.tolist()) for i, v in enumerate(out)]


def result(spark, rows, schema=SCHEMA):
    got = capfilter.deduplicated(spark.createDataFrame(rows, schema).repartition(5)).collect()
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}


@pytest.fixture()
def small_cells(monkeypatch):
    monkeypatch.setattr(capfilter, "CHUNK", 16)


def test_groups_equal_all_pairs(spark):
    rows = groups(1)
    want, pairs = brute(rows)
    assert len(pairs) > 700
    assert result(spark, rows) == want


def test_cells_of_a_large_filter_equal_all_pairs(spark, small_cells):
    rows = groups(2, sizes=(90, 3), singles=100)
    assert result(spark, rows) == brute(rows)[0]


@pytest.mark.parametrize("dimensions", [1, 2, 3, 7, 33, 200])
def test_any_number_of_dimensions(spark, dimensions):
    rows = groups(3, dimensions, sizes=(4, 6), singles=20, cosine=0.999)
    got, (want, pairs) = result(spark, rows), brute(rows)
    assert sum(v[0] for v in got.values()) >= 0.9 * sum(v[0] for v in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)


def test_recall_at_the_threshold_and_none_below(spark):
    """Pairs exactly around 0.95: at least 0.95 of them found, never one below."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        x = rng.normal(size=64)
        rows += [(2 * i, x.tolist()), (2 * i + 1, near(rng, x, 0.95 + (i % 3 - 1) * 1e-4).tolist())]
    want, pairs = brute(rows)
    got = result(spark, rows)
    found = {i for i in want if got[i][0]}
    assert found <= {i for p in pairs for i in p}
    assert len(found) >= 0.95 * 2 * len(pairs) and 300 < len(pairs) < 500


def test_recall_where_many_vectors_make_caps_small():
    """The same parameters as for 100 million vectors; only decoding is needed to see shared filters."""
    rng = np.random.default_rng(5)
    filters = capfilter.Filters(64, 100_000_000, 0.95)
    x = rng.normal(size=(300, 64))
    y = np.array([near(rng, v, 0.951) for v in x])
    sides = [filters.decode(capfilter.units(v)) for v in (x, y)]
    lists = [[set(n[v == i].tolist()) for i in range(300)] for v, n in sides]
    assert sum(bool(a & b) for a, b in zip(*lists, strict=True)) >= 0.9 * 300
    assert np.mean([len(a) for a in lists[0]]) < 60


def test_decoding_lists_exactly_the_exceeding_filters():
    rng = np.random.default_rng(6)
    filters = capfilter.Filters(20, 5000, 0.95)
    unit = capfilter.units(rng.normal(size=(50, 20)))
    vector, number = filters.decode(unit)
    w = filters.words
    want = {(v, (c * w + i) * w + j) for v in range(50) for c in range(capfilter.CODES) for i in range(w) for j in range(w)
            if (unit @ filters.left)[v, c * w + i] + (unit @ filters.right)[v, c * w + j] >= filters.threshold}
    assert set(zip(vector.tolist(), number.tolist(), strict=True)) == want


def test_copies_count_as_links_without_being_paired(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=64)
    rows = [(i, x.tolist()) for i in range(50, 350)] + [(1, near(rng, x, 0.99).tolist()), (2, (3 * x).tolist()), (9, (-x).tolist())]
    assert result(spark, rows) == brute(rows)[0]


def test_messy_rows(spark):
    nan, inf = float("nan"), float("inf")
    x = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, x), (2, None), (3, []), (4, [0.0] * 4), (5, [1.0, nan, 0.0, 0.0]), (6, [inf, 1.0, 1.0, 1.0]), (7, [1.0, None, 1.0, 1.0]),
            (8, [2.0, 4.0, 6.0, 8.0]), (9, [*x, 0.0]), (1, x), (10, x), (11, [1e-38, 2e-38, 3e-38, 4e-38]), (None, x), (None, None)]
    frame = spark.createDataFrame([(*r, 7, 7, "k") for r in rows], SCHEMA + ", n long, rep long, h1 string")
    got = capfilter.deduplicated(frame).collect()
    assert len(got) == len(rows)
    linked = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None}
    assert {i: v for i, v in linked.items() if i in (1, 8, 10, 11)} == {
        1: (3, 1, True), 8: (3, 1, False), 10: (3, 1, False), 11: (3, 1, False)}
    assert all(linked[i] == (0, i, True) for i in (2, 3, 4, 5, 6, 7, 9))
    assert [tuple(r)[1:] for r in got if r.vec_id is None] == [(0, None, True)] * 2
    assert capfilter.deduplicated(frame.limit(0)).count() == 0
