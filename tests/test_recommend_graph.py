import math
import random
from collections import Counter, defaultdict, deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsledger.operators import joins
from opsledger.plans import graph, recommend

RATINGS = "user string, item string, rating double"


def cosine(data, target):
    """All rating pairs of every user, as the definition says."""
    pairs = defaultdict(list)
    for u, i, x in data:
        for v, j, y in data:
            if u == v and i == target and j != target:
                pairs[j].append((x, y))
    out = {}
    for j, p in pairs.items():
        norm = math.sqrt(sum(x * x for x, _ in p)) * math.sqrt(sum(y * y for _, y in p))
        out[j] = (sum(x * y for x, y in p) / norm if norm else 0.0, len(p))
    return out


def test_similarity_equals_all_pairs_with_repeated_reviews(spark):
    rng = random.Random(3)
    data = [(f"u{rng.randint(0, 8)}", f"i{rng.randint(0, 6)}", float(rng.randint(0, 5))) for _ in range(150)]
    data += [("solo", "i1", 0.0), ("solo", "zero", 3.0)]
    want = cosine(data, "i1")
    got = recommend.similar_items(spark.createDataFrame(data, RATINGS), "i1", score_above=-1.0, pairs_above=0).collect()
    assert {r.item: (round(r.score, 9), r.pairs) for r in got} == {j: (round(s, 9), n) for j, (s, n) in want.items()}
    assert all(s <= 1 + 1e-9 for s, _ in want.values())
    assert want["zero"] == (0.0, 1)


def test_similarity_by_shuffle_when_raters_are_many(spark, monkeypatch):
    data = [("hot", "t", 2.0)] + [("hot", f"i{k}", 3.0) for k in range(200)] + [(f"u{k}", i, 1.0) for k in range(60) for i in ("t", "i0")]
    frame = spark.createDataFrame(data, RATINGS)
    want = {tuple(r) for r in recommend.similar_items(frame, "t", -1.0, 0).collect()}
    monkeypatch.setattr(joins, "is_small", lambda df, max_rows=0: False)
    assert {tuple(r) for r in recommend.similar_items(frame, "t", -1.0, 0).collect()} == want
    assert len(want) == 200


def test_averages_and_user_ratings(spark):
    ratings = spark.createDataFrame([("u", "a", 4.0), ("v", "a", 3.0), ("u", "b", 3.0), ("u", "c", 5.0)], RATINGS)
    names = spark.createDataFrame([("a", "Mint"), ("b", "Maple"), ("c", "Nut")], "item string, name string")
    assert [tuple(r) for r in recommend.item_averages(ratings, names, prefix="M").collect()] == [("a", "Mint", 3.5)]
    assert {tuple(r) for r in recommend.user_ratings(ratings, names, "v").collect()} == {("a", "Mint", 3.0)}
    top = recommend.top_similar(ratings, names, "a", score_above=0.0, pairs_above=0)
    assert {r.item for r in top.collect()} == {"b", "c"}


def test_als_recommendations_are_the_largest_factor_products(spark):
    rng = random.Random(4)
    data = [(f"u{u}", f"i{i}", float(rng.randint(1, 5))) for u in range(20) for i in range(15) if rng.random() < 0.5]
    ratings = spark.createDataFrame(data, RATINGS)
    names = spark.createDataFrame([(f"i{i}", f"name {i}") for i in range(15)], "item string, name string")
    indexed, users, items = recommend.with_indexes(ratings)
    model = recommend.fit_als(indexed, rank=3, maxIter=4)
    got = recommend.recommend(model, users, items, names, "u1", 5).collect()
    user = users.where(F.col("user") == "u1").first().user_index
    factor = np.array(model.userFactors.where(F.col("id") == user).first().features)
    by_index = {r.item_index: r.item for r in items.collect()}
    scores = {by_index[r.id]: float(factor @ np.array(r.features)) for r in model.itemFactors.collect()}
    best = sorted(scores, key=scores.get, reverse=True)[:5]
    assert {r.item for r in got} == set(best)
    assert all(r.name == "name " + r.item[1:] and abs(r.predicted - scores[r.item]) < 1e-4 for r in got)


def test_residuals_tell_a_fitted_model_from_a_spoiled_one(spark):
    rng = random.Random(5)
    data = [(f"u{u}", f"i{i}", float(rng.randint(1, 5))) for u in range(30) for i in range(12) if rng.random() < 0.6]
    data += [("hot", f"i{k % 12}", float(k % 5 + 1)) for k in range(3000)]      # one user has most ratings
    indexed, users, items = recommend.with_indexes(spark.createDataFrame(data, RATINGS))
    model = recommend.fit_als(indexed, rank=3, maxIter=3)
    found = {r.user: (r.ratings, r.residual) for r in recommend.residuals(model, indexed).join(users, "user_index").collect()}
    assert {u: n for u, (n, _) in found.items()} == Counter(u for u, _, _ in data)
    assert all(r < 1e-3 for _, r in found.values())
    # by hand for the hot user, with its factors moved a little
    factors = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    of = {r.item: r.item_index for r in items.collect()}
    own = users.where("user = 'hot'").first().user_index
    x = np.array(model.userFactors.where(F.col("id") == own).first().features) * 1.1
    mine = [(factors[of[i]], r) for u, i, r in data if u == "hot"]
    left = sum((y @ x - r) * y for y, r in mine) + 0.01 * len(mine) * x
    want = np.linalg.norm(left) / np.linalg.norm(sum(r * y for y, r in mine))

    class Spoiled:
        rank, itemFactors = 3, model.itemFactors
        userFactors = model.userFactors.withColumn("features", F.transform("features", lambda v: v.cast("double") * 1.1))

    spoiled = {r.user_index: r.residual for r in recommend.residuals(Spoiled, indexed).collect()}
    assert abs(spoiled[own] - want) < 1e-6 and want > 1e-3
    scores = {r.item: r.product for r in recommend.products(model, users, items, "u3").collect()}
    u3 = np.array(model.userFactors.where(F.col("id") == users.where("user = 'u3'").first().user_index).first().features)
    assert scores.keys() == of.keys() and all(abs(s - float(u3 @ factors[of[i]])) < 1e-5 for i, s in scores.items())


def bfs(pairs, start, limit):
    neighbours = defaultdict(list)
    for a, b in pairs:
        neighbours[a].append(b)
    seen, queue = {start: 0}, deque([start])
    while queue:
        n = queue.popleft()
        if seen[n] < limit:
            for m in neighbours[n]:
                if m not in seen:
                    seen[m] = seen[n] + 1
                    queue.append(m)
    return seen


@pytest.mark.parametrize("hub", [False, True])
def test_levels_equal_plain_search(spark, hub):
    rng = random.Random(9)
    pairs = [(rng.randint(0, 40), rng.randint(0, 40)) for _ in range(70)]
    if hub:      # one node holds most edges
        pairs += [(1, k) for k in range(100, 400)] + [(0, 1)]
    lines = spark.createDataFrame([(f"{a} {b}",) for a, b in pairs], "value string")
    found = graph.separation(graph.edges(lines), 0)
    got = {r.node: r.distance for r in found.levels(spark).collect()}
    assert got == bfs(pairs, 0, len(pairs)) and found.exhausted
    for a, b in pairs:
        if a in got:
            assert got[b] <= got[a] + 1


def test_target_hits_unreachable_and_round_limit(spark):
    lines = spark.createDataFrame([("1 2 3",), ("1 4",), ("2 9 9",), ("3 9",), ("9 1",), ("50 51",), ("bad 1",)], "value string")
    edges = graph.edges(lines)
    found = graph.separation(edges, 1, 9)
    assert found.found and found.rounds == 2
    # two parallel edges from 2 and one from 3 reach the target in the second round
    assert [tuple(r) for r in found.target(spark, 9).collect()] == [(9, 2, 3)]
    missing = graph.separation(edges, 1, 51)
    assert not missing.found and missing.target(spark, 51).count() == 0
    chain = spark.createDataFrame([(f"{i} {i + 1}",) for i in range(15)], "value string")
    short = graph.separation(graph.edges(chain), 0, 14, max_rounds=10)
    assert not short.found and short.rounds == 10
    assert short.levels(spark).count() == 6 and not short.exhausted     # five rounds from each end
    assert graph.separation(graph.edges(chain), 0, max_rounds=10).levels(spark).count() == 11
    enough = graph.separation(graph.edges(chain), 0, 14, max_rounds=14)
    assert enough.found and [tuple(r) for r in enough.target(spark, 14).collect()] == [(14, 14, 1)]
    same = graph.separation(graph.edges(chain), 3, 3)
    assert same.found and same.rounds == 0 and [tuple(r) for r in same.target(spark, 3).collect()] == [(3, 0, 0)]
    whole = graph.separation(graph.edges(chain), 0)
    assert whole.levels(spark).count() == 16 and whole.exhausted


@pytest.mark.parametrize("seed,hub", [(1, False), (3, True)])
def test_search_from_both_ends_equals_plain_search(spark, seed, hub):
    rng = random.Random(seed)
    pairs = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(110)]
    if hub:      # most edges leave one node and enter another one
        pairs += [(5, k) for k in range(100, 400)] + [(k, 6) for k in range(100, 400)] + [(0, 5), (6, 61), (5, 100)]
    edges = graph.edges(spark.createDataFrame([(f"{a} {b}",) for a, b in pairs], "value string")).cache()
    near = bfs(pairs, 0, len(pairs))
    for target in (61 if hub else 1, 17, 999):
        found = graph.separation(edges, 0, target)
        got = [tuple(r) for r in found.target(spark, target).collect()]
        if target in near:
            hits = sum(b == target and near.get(a) == near[target] - 1 for a, b in pairs)
            assert got == [(target, near[target], hits)] and found.rounds == near[target]
        else:
            assert got == [] and found.exhausted and not found.found
    edges.unpersist()


def test_rounds_shuffle_neither_edges_nor_visited_nodes(spark, monkeypatch):
    """With buckets as many as the stored bytes ask for; broadcasts are off, as for tables of any size."""
    monkeypatch.setattr(graph, "BUCKET_BYTES", 1 << 10)
    seen = []
    plain = graph.Side.advance

    def advance(side):
        seen.append((side.buckets, side.fresh()._jdf.queryExecution().executedPlan().toString()))
        plain(side)

    monkeypatch.setattr(graph.Side, "advance", advance)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.createDataFrame([(f"{i} {i * 7 % 900} {i * 11 % 900}",) for i in range(900)], "value string")
        assert graph.separation(graph.edges(lines), 1, max_rounds=3).rounds == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for buckets, plan in seen:
        assert buckets > 4 and plan.count("Exchange hashpartitioning") == 2      # the sums, and the new nodes
        for line in plan.splitlines():
            if "Exchange hashpartitioning" in line:
                assert "node" in line or "dst" in line
        assert plan.count("Bucketed: true") + plan.count("SelectedBucketsCount") >= 3


def test_degrees_over_several_lines(spark):
    lines = spark.createDataFrame([("1 2 3\t",), (" 1  4 ",), ("2 \t",), ("\t7 1 1 1",)], "value string")
    names = spark.createDataFrame([(1, "ONE"), (7, "SEVEN")], "node bigint, name string")
    assert [tuple(r) for r in graph.top_nodes(lines, names, 3).collect()] == [(1, "ONE", 3), (7, "SEVEN", 3), (2, None, 0)]
    sums = {r.degree: (int(r.sum_node), int(r.sum_degree)) for r in graph.degree_sums(lines).collect()}
    assert sums == {2: (1, 2), 1: (1, 1), 0: (2, 0), 3: (7, 3)}


def test_blocks_of_a_fit_do_not_follow_the_shuffle_partitions(spark, monkeypatch):
    data = [(f"u{i % 9}", f"i{i % 7}", float(1 + i % 5)) for i in range(120)]
    indexed, _, _ = recommend.with_indexes(spark.createDataFrame(data, RATINGS))
    asked = []

    class Recorded(recommend.ALS):
        def __init__(self, **settings):
            asked.append((settings["numUserBlocks"], settings["numItemBlocks"]))
            super().__init__(**settings)

    monkeypatch.setattr(recommend, "ALS", Recorded)
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        recommend.fit_als(indexed, rank=2, maxIter=1)
        monkeypatch.setattr(recommend, "BLOCK_RATINGS", 20)
        recommend.fit_als(indexed, rank=2, maxIter=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert asked == [(4, 4), (6, 6)]


def test_blocks_of_a_large_fit_are_bounded_and_wait_on_disk(spark, monkeypatch):
    asked = []

    class Recorded(recommend.ALS):
        def fit(self, ratings):
            asked.append((self.getNumUserBlocks(), self.getNumItemBlocks(), self.getIntermediateStorageLevel()))

    class Ratings:
        sparkSession = spark
        rows = 216_000_000

        def count(self):
            return self.rows

    monkeypatch.setattr(recommend, "ALS", Recorded)
    ratings = Ratings()
    recommend.fit_als(ratings)
    ratings.rows = 600_000
    recommend.fit_als(ratings)
    assert asked == [(5, 5, "DISK_ONLY"), (4, 4, "DISK_ONLY")]


def test_ratings_are_joined_once_and_hot_keys_sought_in_stored_rows(spark, monkeypatch):
    data = [("hot" if i % 3 else f"u{i}", f"i{i % 7}", float(1 + i % 5)) for i in range(200)]
    sought, found = [], joins.hot_keys
    monkeypatch.setattr(joins, "is_small", lambda df, *_: False)
    monkeypatch.setattr(joins, "hot_keys", lambda df, key: sought.append(df) or found(df, key))
    indexed, users, items = recommend.with_indexes(spark.createDataFrame(data, RATINGS))
    model = recommend.fit_als(indexed, rank=2, maxIter=1)
    residuals = recommend.residuals(model, indexed)
    assert {r.user: r.ratings for r in residuals.join(users, "user_index").collect()} == Counter(d[0] for d in data)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in [indexed, *sought]]
    assert len(plans) == 5 and not any("Join" in plan for plan in plans)
