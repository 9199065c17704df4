"""Registered recommendation, graph and word queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from opsledger.catalog import sql as q
from opsledger.functions import predicates as p
from opsledger.operators import ranking
from opsledger.operators.indexing import dense_index
from opsledger.plans import graph, recommend, words
from opsledger.session import new_run_dir
from opsledger.sources import dimensions
from opsledger.sources.files import read_json_rows, read_table
from opsledger.testbed import tables as t

TARGET_ITEM = 1
ONE_USER = 1
RESIDUAL = 1e-3
START_NODE = -1            # the order with key 0
TARGET_NODE = -101         # the order with key 100


def item_avg_rating(spark, d):
    return recommend.item_averages(t.ratings(spark, d), t.item_names(spark, d), prefix="s")


def item_avg_rating_top10(spark, d):
    averages = recommend.item_averages(t.ratings(spark, d), t.item_names(spark, d), prefix="s")
    return ranking.top(averages, 10, "average", ["item"])


def item_similarity(spark, d):
    scored = recommend.similar_items(t.ratings(spark, d), TARGET_ITEM)
    return scored.select("item", F.round("score", 9).alias("score"), "pairs")


def item_similarity_all(spark, d):
    """Every item that shares a user with the target, whatever its score."""
    scored = recommend.similar_items(t.ratings(spark, d), TARGET_ITEM, score_above=-1.0, pairs_above=0)
    return scored.select("item", F.round("score", 9).alias("score"), "pairs")


def item_similarity_top10(spark, d):
    return recommend.top_similar(t.ratings(spark, d), t.item_names(spark, d), TARGET_ITEM)


def user_ratings_named(spark, d):
    return recommend.user_ratings(t.ratings(spark, d), t.item_names(spark, d), ONE_USER)


def json_reviews(spark, d):
    """Ratings written as JSON rows and read back with a declared schema."""
    path = new_run_dir(spark, "reviews")
    t.ratings(spark, d).withColumn("unused", F.lit("x")).write.json(path)
    rows = read_json_rows(spark, path, "user bigint, item bigint, rating double")
    return rows.groupBy("item").agg(F.count("*").alias("reviews"), F.sum("rating").alias("stars"))


def _fitted(spark, d):
    indexed, users, items = recommend.with_indexes(t.ratings(spark, d))
    return recommend.fit_als(indexed), indexed, users, items


def als_top10(spark, d):
    model, _, users, items = _fitted(spark, d)
    return recommend.recommend(model, users, items, t.item_names(spark, d), ONE_USER)


def als_top10_facts(spark, d):
    """Size of the model's list, and that its items are known and distinct."""
    best = als_top10(spark, d)
    names = t.item_names(spark, d).withColumnRenamed("name", "known")
    return best.join(names, "item", "left").agg(
        F.count("*").alias("items"), F.countDistinct("item").alias("distinct_items"),
        F.count_if(F.col("name") == F.col("known")).alias("named"), F.count("predicted").alias("predicted"))


def als_residuals(spark, d):
    """Every user with the number of ratings and whether the fitted factors solve the user's least squares."""
    model, indexed, users, _ = _fitted(spark, d)
    found = recommend.residuals(model, indexed).join(users, "user_index")
    return found.select("user", "ratings", (F.col("residual") < RESIDUAL).alias("solved"))


def als_order(spark, d):
    """The model's list for one user against the factor products of all items.

    Per place: the rating is the product, it is not above the one before, and as many items have a larger product as places come before.
    """
    model, _, users, items = _fitted(spark, d)
    best = recommend.recommend(model, users, items, t.item_names(spark, d), ONE_USER)
    scored = recommend.products(model, users, items, ONE_USER)
    listed = best.join(scored, "item").withColumn("place", F.row_number().over(Window.orderBy(F.col("predicted").desc(), "item")))
    # ten products reach the driver; the items are counted against all of them in one pass
    larger = scored.agg(*[F.count_if(F.col("product") > r.product + 1e-4).alias(str(r.place)) for r in listed.collect()])
    above = larger.unpivot([], larger.columns, "place", "above").select(F.col("place").cast("int"), "above")
    before = F.lag("predicted").over(Window.orderBy("place"))
    return listed.join(above, "place").select(
        "place", (F.abs(F.col("predicted") - F.col("product")) < 1e-4).alias("is_product"),
        F.coalesce(F.col("predicted") <= before, F.lit(True)).alias("in_order"), (F.col("above") < F.col("place")).alias("none_missed"))


def dense_ids(spark, d):
    """Every user and item with its dense id: the place of the key in the order of keys."""
    ratings = t.ratings(spark, d)

    def side(name):
        ids = dense_index(ratings, name, "id")
        return ids.select(F.lit(name).alias("side"), F.col(name).alias("key"), "id")

    return side("user").unionByName(side("item"))


def _graph_lines(spark, d):
    return t.graph_lines(read_table(spark, d, "lineitem"))


def _names(spark, d):
    return dimensions.quoted_names(t.name_lines(read_table(spark, d, "part")))


def adjacency_rejects(spark, d):
    """Adjacency lines of parts of which some have no node id or a neighbour that is none."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    value = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("part "), key)).when(
        F.col("p_partkey") % 7 == 0, F.concat(key, F.lit(" "), size, F.lit(" z"))).otherwise(F.concat(key, F.lit(" "), size))
    return graph.rejected_lines(read_table(spark, d, "part").select(value.alias("value"))).select("value", "parse_error")


def graph_edges(spark, d):
    return graph.edges(_graph_lines(spark, d))


def node_degrees(spark, d):
    return graph.node_degrees(_graph_lines(spark, d))


def degree_top10(spark, d):
    """The best connected named nodes."""
    names = _names(spark, d)
    degrees = graph.node_degrees(_graph_lines(spark, d)).join(names, "node", "inner")
    return ranking.top(degrees.select("node", "name", "degree"), 10, "degree", ["node"])


def degree_top10_any(spark, d):
    """The best connected nodes of any kind; most of the very best have no name."""
    return graph.top_nodes(_graph_lines(spark, d), _names(spark, d))


def degree_histogram_sums(spark, d):
    sums = graph.degree_sums(_graph_lines(spark, d))
    return sums.select(
        "degree", F.col("sum_node").cast("double").alias("sum_node"), F.col("sum_degree").cast("bigint").alias("sum_degree")
    ).orderBy(F.col("degree").desc())


def bfs_levels(spark, d):
    return graph.separation(graph.edges(_graph_lines(spark, d)), START_NODE).levels(spark)


def bfs_degrees(spark, d):
    found = graph.separation(graph.edges(_graph_lines(spark, d)), START_NODE, TARGET_NODE)
    return found.target(spark, TARGET_NODE)


def _words(spark, d, mode):
    return words.word_counts(read_table(spark, d, "documents"), "text", mode)


def word_count_keep(spark, d):
    return _words(spark, d, "keep").orderBy("occurrences", "word")


def word_count_drop(spark, d):
    return _words(spark, d, "drop")


def word_count_bottom30(spark, d):
    return ranking.top(_words(spark, d, "drop"), 30, "occurrences", ["word"], descending=False)


QUERIES = {
    f.__name__: f for f in (
        item_avg_rating, item_avg_rating_top10, item_similarity, item_similarity_all, item_similarity_top10,
        user_ratings_named, json_reviews, als_top10, als_top10_facts, als_residuals, als_order, dense_ids, adjacency_rejects, graph_edges, node_degrees, degree_top10, degree_top10_any,
        degree_histogram_sums, bfs_levels, bfs_degrees, word_count_keep, word_count_drop, word_count_bottom30,
    )
}

_STOP = ", ".join(f"'{w}'" for w in p.STOP_WORDS)
_AVERAGES = f"""WITH {q.RATINGS}
    SELECT item, p_name AS name, avg(rating) AS average FROM ratings JOIN part ON p_partkey = item
    WHERE p_name LIKE 's%' GROUP BY item, p_name HAVING avg(rating) > 3"""
_PAIRS = f"""WITH {q.RATINGS},
    pairs AS (SELECT o.item, count(*) AS pairs, sum(t.rating * o.rating) AS xy,
        sum(t.rating * t.rating) AS xx, sum(o.rating * o.rating) AS yy
      FROM ratings t JOIN ratings o ON t."user" = o."user" AND t.item = {TARGET_ITEM} AND o.item <> {TARGET_ITEM}
      GROUP BY o.item),
    scored AS (SELECT item, CASE WHEN sqrt(xx) * sqrt(yy) <> 0 THEN xy / (sqrt(xx) * sqrt(yy)) ELSE 0 END AS raw, pairs FROM pairs)"""
_WORDS = r"""WITH words AS (
    SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM documents)
    SELECT word, count(*) AS occurrences FROM words WHERE word <> '' AND word"""
_REACH = f"""WITH RECURSIVE {q.GRAPH},
    walk(node, distance) USING KEY (node) AS (
      SELECT CAST({START_NODE} AS BIGINT), 0
      UNION
      SELECT e.dst, min(w.distance + 1) FROM walk w JOIN graph_edges e ON e.src = w.node
      LEFT JOIN recurring.walk r ON r.node = e.dst WHERE r.node IS NULL GROUP BY e.dst
    ),
    reached AS (SELECT node, CAST(distance AS INTEGER) AS distance FROM walk)"""

SQL = {
    "als_top10_facts": """SELECT CAST(10 AS BIGINT) AS items, CAST(10 AS BIGINT) AS distinct_items,
        CAST(10 AS BIGINT) AS named, CAST(10 AS BIGINT) AS predicted FROM part HAVING count(*) >= 10""",
    "als_residuals": f"""WITH {q.RATINGS} SELECT CAST("user" AS BIGINT) AS "user", count(*) AS ratings, true AS solved
        FROM ratings GROUP BY "user\"""",
    "als_order": """SELECT CAST(place AS INTEGER) AS place, true AS is_product, true AS in_order, true AS none_missed
        FROM range(1, 1 + least(10, (SELECT count(DISTINCT l_partkey) FROM lineitem))) r(place)""",
    "adjacency_rejects": """SELECT CASE WHEN p_partkey % 5 = 0 THEN 'part ' || p_partkey ELSE p_partkey || ' ' || p_size || ' z' END AS value,
        CASE WHEN p_partkey % 5 = 0 THEN 'no node' ELSE 'bad neighbour' END AS parse_error
        FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 7 = 0""",
    "dense_ids": f"""WITH {q.RATINGS}, sides AS (SELECT DISTINCT 'user' AS side, CAST("user" AS BIGINT) AS "key" FROM ratings
        UNION ALL SELECT DISTINCT 'item', CAST(item AS BIGINT) FROM ratings)
        SELECT side, "key", row_number() OVER (PARTITION BY side ORDER BY "key") - 1 AS id FROM sides""",
    "item_avg_rating": _AVERAGES,
    "item_avg_rating_top10": f"{_AVERAGES} ORDER BY average DESC, item LIMIT 10",
    "item_similarity": f"{_PAIRS} SELECT item, round(raw, 9) AS score, pairs FROM scored WHERE raw > 0.97 AND pairs > 1",
    "item_similarity_all": f"{_PAIRS} SELECT item, round(raw, 9) AS score, pairs FROM scored",
    "item_similarity_top10": f"""{_PAIRS} SELECT item, p_name AS name, round(raw, 9) AS score, pairs
        FROM scored JOIN part ON p_partkey = item WHERE raw > 0.97 AND pairs > 1 ORDER BY score DESC, item LIMIT 10""",
    "user_ratings_named": f"""WITH {q.RATINGS} SELECT item, p_name AS name, rating
        FROM ratings JOIN part ON p_partkey = item WHERE "user" = {ONE_USER}""",
    "json_reviews": f"WITH {q.RATINGS} SELECT item, count(*) AS reviews, sum(rating) AS stars FROM ratings GROUP BY item",
    "graph_edges": f"WITH {q.GRAPH} SELECT src, dst, n FROM graph_edges",
    "node_degrees": f"WITH {q.GRAPH} SELECT node, CAST(sum(degree) AS BIGINT) AS degree FROM line_degrees GROUP BY node",
    "degree_top10": f"""WITH {q.GRAPH} SELECT node, p_name AS name, CAST(sum(degree) AS BIGINT) AS degree
        FROM line_degrees JOIN part ON p_partkey = node WHERE p_size <> 1
        GROUP BY node, p_name ORDER BY degree DESC, node LIMIT 10""",
    "degree_top10_any": f"""WITH {q.GRAPH}, d AS (
        SELECT node, CAST(sum(degree) AS BIGINT) AS degree FROM line_degrees GROUP BY node
        ORDER BY degree DESC, node LIMIT 10)
        SELECT node, p_name AS name, degree FROM d LEFT JOIN part ON p_partkey = node AND p_size <> 1""",
    "degree_histogram_sums": f"""WITH {q.GRAPH} SELECT CAST(degree AS BIGINT) AS degree,
        CAST(sum(node) AS DOUBLE) AS sum_node, CAST(sum(degree) AS BIGINT) AS sum_degree
        FROM line_degrees GROUP BY degree ORDER BY 1 DESC""",
    "bfs_levels": f"{_REACH} SELECT node, distance FROM reached",
    "bfs_degrees": f"""{_REACH} SELECT t.node, t.distance, CAST(sum(e.n) AS BIGINT) AS hits
        FROM reached t JOIN graph_edges e ON e.dst = t.node
        JOIN reached s ON s.node = e.src AND s.distance = t.distance - 1
        WHERE t.node = {TARGET_NODE} GROUP BY t.node, t.distance""",
    "word_count_keep": f"{_WORDS} IN ({_STOP}) GROUP BY word ORDER BY 2, 1",
    "word_count_drop": f"{_WORDS} NOT IN ({_STOP}) GROUP BY word",
    "word_count_bottom30": f"{_WORDS} NOT IN ({_STOP}) GROUP BY word ORDER BY 2, 1 LIMIT 30",
}
