"""Graph jobs on adjacency lines: degree ranking and degrees of separation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsledger.functions.text import tokens
from opsledger.operators import joins, ranking
from opsledger.operators.compute import with_computed
from opsledger.session import new_run_dir, remove_dir


def _adjacency(lines: DataFrame) -> DataFrame:
    """``node, neighbours`` per line ``node neighbour neighbour ...``; lines without a node id are left out."""
    split = with_computed(lines, {"_tokens": tokens(F.regexp_replace("value", r"^\s+", ""))})
    return split.select(
        F.get("_tokens", F.lit(0)).try_cast("bigint").alias("node"),
        F.slice("_tokens", 2, F.size("_tokens")).alias("neighbours"),
    ).where(F.col("node").isNotNull())


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Adjacency lines without a node id, or with a neighbour that is no id, and the reason in ``parse_error``."""
    split = with_computed(lines, {"_tokens": tokens(F.regexp_replace("value", r"^\s+", ""))})
    bad = F.exists(F.slice("_tokens", 2, F.size("_tokens")), lambda t: t.try_cast("bigint").isNull())
    problem = F.when(F.get("_tokens", F.lit(0)).try_cast("bigint").isNull(), "no node").when(bad, "bad neighbour")
    return split.withColumn("parse_error", problem).where(F.col("parse_error").isNotNull()).drop("_tokens")


def line_degrees(lines: DataFrame) -> DataFrame:
    """``node, degree`` per adjacency line."""
    return _adjacency(lines).select("node", F.size("neighbours").cast("bigint").alias("degree"))


def edges(lines: DataFrame) -> DataFrame:
    """Directed edges with their multiplicity; a node may span several lines."""
    pairs = _adjacency(lines).select(F.col("node").alias("src"), F.explode("neighbours").alias("neighbour"))
    pairs = pairs.select("src", F.col("neighbour").try_cast("bigint").alias("dst")).where(F.col("dst").isNotNull())
    return pairs.groupBy("src", "dst").agg(F.count("*").alias("n"))


def node_degrees(lines: DataFrame) -> DataFrame:
    return line_degrees(lines).groupBy("node").agg(F.sum("degree").alias("degree"))


def top_nodes(lines: DataFrame, names: DataFrame, n: int = 10) -> DataFrame:
    """The best connected nodes; only they are looked up by name."""
    best = ranking.top(node_degrees(lines), n, "degree", ["node"])
    named = names.join(F.broadcast(best.select("node")), "node", "left_semi")
    return best.join(F.broadcast(named), "node", "left").select("node", "name", "degree")


def degree_sums(lines: DataFrame) -> DataFrame:
    """Every numeric column summed per line degree."""
    return ranking.numeric_sums(line_degrees(lines), "degree")


LEVEL = "node bigint, hits bigint, distance int"
# a bucket holds so many bytes of stored edges, until there are as many buckets as a table should have
BUCKET_BYTES = 4 << 20
MOST_BUCKETS = 50_000


@dataclass(frozen=True)
class Separation:
    """A finished search: where its result is stored and how it ended.

    ``exhausted`` means that a frontier had no new neighbours: without a target ``levels`` then holds every reachable
    node, with one the target cannot be reached.
    """

    folder: str
    rounds: int
    found: bool
    exhausted: bool

    def levels(self, spark: SparkSession) -> DataFrame:
        """``node, distance`` of every node reached from the start; with a target only those its side came to."""
        return spark.read.schema(LEVEL).parquet(f"{self.folder}/reached").select("node", "distance")

    def target(self, spark: SparkSession, target: int) -> DataFrame:
        """Distance of the target and the number of edges that reach it from the level before; empty if unreached."""
        return spark.read.schema(LEVEL).parquet(f"{self.folder}/target").where(F.col("node") == target) \
            .select("node", "distance", "hits")


def separation(edge_table: DataFrame, start: int, target: int | None = None,
               max_rounds: int | None = None) -> Separation:
    """Breadth-first search from the start, level by level, until no new node is reached; or between start and target.

    With a target the search runs from both ends, always over the smaller frontier, until a new level meets a node of
    the other side. Distances then add up, and the hits of the target are counted along shortest paths only.
    ``max_rounds`` ends the search earlier on request; ``exhausted`` of the result tells whether it did.

    Edges and levels are tables in the shared folder, so a round reads files instead of a growing lineage and lost
    executors repeat one round at most.
    """
    spark = edge_table.sparkSession
    folder = new_run_dir(spark, "separation")
    stored = f"{folder}/edges"
    edge_table.select("src", "dst", "n").write.parquet(stored)
    buckets = min(MOST_BUCKETS, max(1, -(-stored_bytes(spark, stored) // BUCKET_BYTES)))
    sides = []
    try:
        sides.append(Side(spark, f"{folder}/forward", spark.read.parquet(stored), buckets, start))
        if target is None:
            rounds = 0
            while sides[0].size and (max_rounds is None or rounds < max_rounds):
                sides[0].advance()
                rounds += 1
            done = Separation(folder, rounds, False, not sides[0].size)
        else:
            turned = spark.read.parquet(stored).select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
            sides.append(Side(spark, f"{folder}/backward", turned, buckets, target))
            done = _meet(spark, folder, *sides, start, target, max_rounds)
        sides[0].levels().write.parquet(f"{folder}/reached")
        return done
    finally:
        for side in sides:
            side.close()
        for part in ("edges", "forward", "backward"):
            remove_dir(spark, f"{folder}/{part}")


def _meet(spark: SparkSession, folder: str, ahead: Side, back: Side, start: int, target: int,
          max_rounds: int | None) -> Separation:
    met = start == target
    while not met and ahead.size and back.size and (max_rounds is None or ahead.depth + back.depth < max_rounds):
        mover, other = (ahead, back) if (ahead.size, ahead.depth) <= (back.size, back.depth) else (back, ahead)
        mover.advance()
        met = not mover.level(mover.depth).join(other.level(other.depth).select("node"), "node", "left_semi").isEmpty()
    rounds = ahead.depth + back.depth
    if met:
        # nodes on shortest paths, from the level where both sides met to the last one before the target
        path = ahead.level(ahead.depth).join(back.level(back.depth).select("node"), "node", "left_semi").select("node", "hits")
        for depth in range(back.depth - 1, -1, -1):
            step = f"{folder}/path-{depth}"
            path.write.parquet(step)
            reached = ahead.follow(spark.read.schema("node bigint, hits bigint").parquet(step).select("node"))
            path = reached.groupBy(F.col("dst").alias("node")).agg(F.sum("n").alias("hits")).join(
                back.level(depth).select("node"), "node", "left_semi")
        found = path.withColumn("distance", F.lit(rounds))
    else:
        found = spark.createDataFrame([], LEVEL)
    found.write.parquet(f"{folder}/target")
    for depth in range(back.depth):
        remove_dir(spark, f"{folder}/path-{depth}")
    return Separation(folder, rounds, met, not met and not (ahead.size and back.size))


def stored_bytes(spark: SparkSession, path: str) -> int:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


class Side:
    """One direction of a search: the edges by the node they leave, and the nodes reached so far, in equal buckets.

    Buckets of a frontier meet the same buckets of the edges, and newly reached nodes meet the same buckets of the
    visited ones: neither edges nor visited nodes are ever shuffled, only what a round reaches. Edges of very
    well connected nodes would overfill a bucket; they are stored apart and meet a broadcast of the frontier's hot
    nodes, of which there are fewer than shuffle partitions.
    """

    def __init__(self, spark: SparkSession, folder: str, edge_table: DataFrame, buckets: int, start: int):
        self.spark, self.folder, self.buckets = spark, folder, buckets
        name = "".join(c if c.isalnum() else "_" for c in folder[-50:])
        self.cold, self.reached = f"edges_{name}", f"reached_{name}"
        self.depth, self.size = 0, 1
        joins.hot_keys(edge_table, "src").write.parquet(f"{folder}/hot")
        hot = F.broadcast(spark.read.parquet(f"{folder}/hot"))
        self.skewed = not hot.isEmpty()
        cold = edge_table.join(hot, "src", "left_anti") if self.skewed else edge_table
        cold.repartition(buckets, "src").write.bucketBy(buckets, "src").option("path", f"{folder}/cold").saveAsTable(self.cold)
        if self.skewed:
            edge_table.join(hot, "src", "left_semi").write.parquet(f"{folder}/hot_edges")
        self._append(spark.range(1).select(F.lit(start).cast("bigint").alias("node"), F.lit(0).cast("bigint").alias("hits")), 0)

    def _append(self, nodes: DataFrame, depth: int) -> None:
        nodes.withColumn("distance", F.lit(depth)).write.mode("append").partitionBy("distance").bucketBy(
            self.buckets, "node").option("path", f"{self.folder}/reached").saveAsTable(self.reached)

    def levels(self) -> DataFrame:
        return self.spark.table(self.reached)

    def level(self, depth: int) -> DataFrame:
        return self.levels().where(F.col("distance") == depth)

    def follow(self, frontier: DataFrame) -> DataFrame:
        """The edges that leave the frontier's nodes."""
        nodes = frontier.select(F.col("node").alias("src"))
        out = self.spark.table(self.cold).join(nodes.hint("shuffle_hash"), "src")
        if self.skewed:
            few = F.broadcast(nodes.join(F.broadcast(self.spark.read.parquet(f"{self.folder}/hot")), "src", "left_semi"))
            out = out.unionByName(self.spark.read.parquet(f"{self.folder}/hot_edges").join(few, "src"))
        return out

    def fresh(self) -> DataFrame:
        """``node, hits`` of the next level: summed while mapping, then dealt like the visited nodes."""
        step = self.follow(self.level(self.depth))
        reached = step.groupBy(F.col("dst").alias("node")).agg(F.sum("n").alias("hits"))
        return reached.repartition(self.buckets, "node").join(self.levels().select("node"), "node", "left_anti")

    def advance(self) -> None:
        self._append(self.fresh(), self.depth + 1)
        self.depth += 1
        self.size = self.level(self.depth).count()

    def close(self) -> None:
        for name in (self.cold, self.reached):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")      # the names only; the files are external
