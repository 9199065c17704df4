"""N-gram Jaccard join: a grouped prefix join with exact verification.

A document's set holds the hashes of its distinct word shingles. In one global order of all shingles, two sets with
similarity ``num / den`` or more share a shingle in the first ``size - ceil(size * num / den) + 1`` of each. The order
is by frequency class, rare first, then by hash. Frequencies are counted over all documents in a table of ``cells``
counters; a coarse count makes the join slower, never wrong.

1. Documents with equal sets are one set; sets with identical prefix and size are one group.
2. Groups that share a prefix shingle, have close sizes and can still reach the overlap after the shared position
   are pairs. First each shingle's groups are paired with two leaders only, and members of a group with one member.
   Those pairs are expanded to sets and verified on the whole sets; linked sets form components.
3. Then all other pairs that join different components are made, expanded and verified. Pairs inside one
   component cannot change a component, so a large group of copies never becomes all its pairs.

The result is exact up to equal 64-bit hashes of different shingles or sets.

Defined cases: null and empty texts have an empty set and are linked with nothing; rows with one doc_id and
different texts are joined to one component; a null doc_id is kept with a null component and links nothing; repeated
rows give equal rows; empty tables give no rows. Extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .shared import broadcast_if_small, small_batches, store, table
from .shingles import shingle_sets

WIDTH, NUM, DEN = 4, 85, 100
MIN_CELL_BITS, MAX_CELL_BITS = 20, 24
CELL_BLOCKS = 32
ID_ROWS = 500_000  # ids of eight bytes that may be broadcast


def cell_bits(n_docs: int) -> int:
    """Bits of the frequency table: four counters a document, within the bounds."""
    return min(max(MIN_CELL_BITS, int(n_docs * 4).bit_length()), MAX_CELL_BITS)


def frequency_classes(docs: DataFrame, width: int, bits: int, make_sets=shingle_sets) -> np.ndarray:
    """Class of the document frequency of each cell, 4 log2 of it, as bytes; at most 2 ** ``MAX_CELL_BITS`` of them."""
    each = (1 << bits) // CELL_BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << bits, np.int64)
        for batch in batches:
            sets = make_sets(batch.column(0).to_pylist(), width)
            found = np.concatenate([*sets, np.zeros(0, np.uint64)])
            cells += np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        if cells.any():
            yield from blocks({i: cells[i * each:(i + 1) * each] for i in range(CELL_BLOCKS)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(data, np.int64)
                sums[i] = sums[i] + counts if i in sums else counts
        yield from blocks(sums)

    def blocks(parts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i, counts in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([counts.tobytes()], pa.binary())],
                                             ["block", "counts"])

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in add(batches):
            counts = np.frombuffer(batch.column(1)[0].as_py(), np.int64)
            made = np.round(4 * np.log2(counts + 1.0)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([made.tobytes()], pa.binary())], ["block", "counts"])

    schema = "block int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema)
    out = np.zeros(1 << bits, np.uint8)
    for row in parts.repartition(CELL_BLOCKS, "block").mapInArrow(classes, schema).collect():
        out[row.block * each:(row.block + 1) * each] = np.frombuffer(row.counts, np.uint8)
    return out


def prefix_length(size: int, num: int, den: int) -> int:
    return size - -(-size * num // den) + 1


def prefixes(docs: DataFrame, classes: np.ndarray, bits: int, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, n, sid, gid, prefix): size, set id, group id and prefix of each document, in global order."""
    known = docs.sparkSession.sparkContext.broadcast(classes)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, sids, gids, out = batch.column(0), [], [], [], []
            for found in shingle_sets(batch.column(1).to_pylist(), width):
                order = known.value[(found >> np.uint64(64 - bits)).astype(np.int64)]
                order = np.lexsort((found, order))[:prefix_length(len(found), num, den)] if len(found) else []
                first = found[order].astype(np.uint64) if len(found) else found
                sizes.append(len(found))
                sids.append(_id(found.tobytes()) if len(found) else None)
                gids.append(_id(first.tobytes() + len(found).to_bytes(8, "little")) if len(found) else None)
                out.append(first.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(sids, pa.int64()), pa.array(gids, pa.int64()),
                 pa.array(out, pa.list_(pa.int64()))], ["doc_id", "n", "sid", "gid", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        describe, "doc_id long, n long, sid long, gid long, prefix array<long>")


def _id(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _possible(a: str, b: str, num: int, den: int) -> Column:
    """Sizes are close enough and the overlap can be reached from the shared positions on."""
    rest = F.expr(f"least({a}_n - {a}_pos, {b}_n - {b}_pos)")
    close = F.expr(f"least({a}_n, {b}_n) * {den} >= greatest({a}_n, {b}_n) * {num}")
    return close & (rest * (num + den) >= F.expr(f"({a}_n + {b}_n) * {num}"))


def verified(docs: DataFrame, one_doc: DataFrame, pairs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of set ids whose sets have the similarity. ``one_doc``: (sid, doc_id) of a holder of each set."""
    sids = store(pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct(), "jaccard-sids")
    needed = store(one_doc.join(sids, "sid"), "jaccard-needed").select("doc_id", "sid")
    sids = broadcast_if_small(sids, ID_ROWS)
    wanted = broadcast_if_small(needed.select("doc_id").distinct(), ID_ROWS)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s for s in shingle_sets(batch.column(0).to_pylist(), width) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([_id(s.tobytes()) for s in found], pa.int64()),
                                              pa.array([s.tobytes() for s in found], pa.binary())], ["sid", "data"])

    holders = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    # only texts of ids with several rows can give a set twice
    several = store(docs.groupBy("doc_id").count().where("count > 1").select("doc_id"), "jaccard-several")
    if not several.isEmpty():
        several = broadcast_if_small(several, ID_ROWS)
        repeated = holders.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        holders = holders.join(several, "doc_id", "left_anti").union(repeated)
    known = store(holders.select("text").mapInArrow(sets, "sid long, data binary").join(sids, "sid", "left_semi"),
                  "jaccard-sets")
    left, right = (known.select(F.col("sid").alias(c), F.col("data").alias(f"{c}_set")) for c in "ab")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(mask) for i in (0, 1)], ["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "a_set", "b_set")
    return joined.mapInArrow(check, "a long, b long")


def linked(docs: DataFrame, width: int = WIDTH, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document; the id is the smallest doc_id reachable by links."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = cell_bits(docs.count())
    classes = frequency_classes(docs, width, bits)
    rows = store(prefixes(docs, classes, bits, width, num, den), "jaccard-prefixes")
    known = rows.where("n > 0 AND doc_id IS NOT NULL")
    sets = store(known.groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.min("gid").alias("gid"),
                                          F.min("n").alias("n")), "jaccard-sets")
    one_doc = sets.select("sid", "doc_id")

    # shingles that begin groups, with the group's size and the shingle's place
    groups = known.groupBy("gid", "n").agg(F.first("prefix").alias("prefix"))
    shared = groups.select("gid", "n", F.posexplode("prefix").alias("pos", "token"))
    often = shared.groupBy("token").agg(F.count("*").alias("groups")).where("groups > 1").select("token")
    places = store(shared.join(often, "token").select("token", "gid", "n", "pos"), "jaccard-places")

    # first pairs: each group with two leaders of its shingles, each set with the first of its group. One leader has the
    # fewest rarer shingles before the shared one, as the text has that the others of a large group are edits of
    by_place = F.col("pos").cast("long") * (1 << 32) + F.col("gid").bitwiseAND((1 << 32) - 1)
    leads = [
        places.groupBy("token").agg(best("gid", order).alias("l_gid"), best("n", order).alias("l_n"),
                                    best("pos", order).alias("l_pos"))
        for best, order in ((F.min_by, by_place), (F.max_by, F.col("gid")))
    ]
    ours = places.select("token", F.col("gid").alias("g_gid"), F.col("n").alias("g_n"), F.col("pos").alias("g_pos"))
    led = ours.join(leads[0].union(leads[1]), "token").where("g_gid <> l_gid").where(_possible("g", "l", num, den))
    first = sets.groupBy("gid").agg(F.min("sid").alias("first"), F.count("*").alias("members"))
    lead_pairs = (
        led.select("g_gid", "l_gid").distinct()
        .join(first.select(F.col("gid").alias("g_gid"), F.col("first").alias("x")), "g_gid")
        .join(first.select(F.col("gid").alias("l_gid"), F.col("first").alias("y")), "l_gid").select("x", "y")
    )
    own = sets.join(first.where("members > 1"), "gid").where("sid <> first").select(
        F.col("sid").alias("x"), F.col("first").alias("y"))
    tried = store(lead_pairs.union(own).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
                  "jaccard-tried")
    links = store(verified(docs, one_doc, tried, width, num, den), "jaccard-links")
    joined = components(links)

    # all other pairs between components
    member = store(
        sets.join(joined.select(F.col("node").alias("sid"), "root"), "sid", "left")
        .select("sid", "gid", F.coalesce("root", "sid").alias("part")), "jaccard-members")
    parts = member.groupBy("gid").agg(F.min("part").alias("p1"), F.max("part").alias("p2"))
    placed = store(places.join(parts, "gid"), "jaccard-placed")
    mixed = placed.groupBy("token").agg(F.min("p1").alias("m1"), F.max("p2").alias("m2")).where("m1 < m2").select("token")
    placed = placed.join(mixed, "token")
    g, h = (placed.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("gid", "n", "pos", "p1", "p2")]) for s in "gh")
    apart = ~((F.col("g_p1") == F.col("g_p2")) & (F.col("h_p1") == F.col("h_p2")) & (F.col("g_p1") == F.col("h_p1")))
    across = g.join(h, "token").where(F.col("g_gid") < F.col("h_gid")).where(apart).where(_possible("g", "h", num, den))
    inside = parts.where("p1 < p2").select(F.col("gid").alias("g_gid"), F.col("gid").alias("h_gid"))
    group_pairs = across.select("g_gid", "h_gid").distinct().union(inside)
    x = member.select(F.col("gid").alias("g_gid"), F.col("sid").alias("x"), F.col("part").alias("x_part"))
    y = member.select(F.col("gid").alias("h_gid"), F.col("sid").alias("y"), F.col("part").alias("y_part"))
    rest = (
        group_pairs.join(x, "g_gid").join(y, "h_gid").where("x_part <> y_part")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    rest = store(rest, "jaccard-rest")
    if not rest.isEmpty():
        more = store(verified(docs, one_doc, rest, width, num, den), "jaccard-more")
        links = links.union(more)

    # rows of one doc_id with different texts belong together
    same = known.groupBy("doc_id").agg(F.min("sid").alias("a"), F.max("sid").alias("b")).where("a < b")
    same = known.join(same, "doc_id").select(F.col("sid").alias("a"), "b").where("a <> b")
    final = components(links.union(same))
    label = sets.select("sid", "doc_id").join(final.select(F.col("node").alias("sid"), "root"), "sid", "left").select(
        "sid", "doc_id", F.coalesce("root", "sid").alias("root"))
    label = store(label, "jaccard-roots")
    smallest = label.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    label = label.join(smallest, "root").select("sid", "component_id")
    alone = rows.where("sid IS NULL OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"),
                                                              F.col("doc_id").alias("component_id"))
    return known.join(label, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(alone)


def one_of_each(docs: DataFrame, width: int = WIDTH, num: int = NUM, den: int = DEN) -> DataFrame:
    """The documents that are the smallest of their component, with the columns of ``docs``; null ids stay.

    Rows that share a kept doc_id all stay.
    """
    found = linked(docs, width, num, den).where("doc_id <> component_id").select("doc_id").distinct()
    dropped = broadcast_if_small(store(found, "jaccard-dropped"), ID_ROWS)
    return docs.join(dropped, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_jaccard(spark, folder: str) -> DataFrame:
    return linked(table(spark, folder, "documents").select("doc_id", "text"))


SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, least(4, len(w)) AS k, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS p
           FROM words WHERE len(w) > 0),
grams AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[p:p + k - 1], ' ') AS gram FROM places),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS MATERIALIZED (SELECT a, b FROM (
    SELECT g.doc_id AS a, h.doc_id AS b, count(*) AS same FROM grams g JOIN grams h USING (gram)
    WHERE g.doc_id <> h.doc_id GROUP BY ALL) JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * same >= 85 * (x.n + y.n - same)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(w.doc_id, coalesce(min(b), w.doc_id)) AS component_id
FROM words w LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id
"""
