"""Exact top-k search: BM25 over sharded inverted indexes with blocks scored in order of their bounds, merged exactly.

Words are those of the decontamination (A-Z in lower case, cut at ASCII characters that are no letters or digits),
known by a 64-bit hash. Tasks write shards of about ``SHARD_WORDS`` words: postings by word, documents of a shard by
length and then id. Numbers of documents and words, and the document frequency of every query word, are summed over
all shards, so scores do not depend on the sharding.

A search goes through a shard for ``BATCH`` queries at a time. Words that stand in at least one of ``COMMON`` documents are
laid out as a dense table, all others are postings. A query's rare words are summed exactly; the largest weights of its
common words in each block of ``BLOCK`` documents bound the rest, and only documents that can reach the k-th score go on.
Where more than ``FEW`` do, as for long queries whose best scores are close, one product of matrices adds the common words
of all such queries of the batch, in single precision with a bound of its error. Documents that still can reach the
k-th score get their exact score, summed in the order of the words, so equal documents have equal scores in every shard.
That k-th score is kept from shard to shard of a task. The k best of every task are merged by score, then by smaller
doc_id. This takes the place of WAND's cursors and pivots: it prunes by the same bounds, in few steps over arrays.

Queries go through the shards in blocks of about ``QUERY_PAIRS`` (query, word) pairs, which are broadcast.

Defined cases: null and empty texts are found by nothing and find nothing; a null doc_id can be found and ranks after
equal scores with an id; of several queries with one id the smallest text is asked; a repeated row is a document of its own; fewer than k documents with a common word give
fewer rows; empty tables give no rows. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shared import pieces, small_batches, store, table
from .shingles import ranges, word_hashes

K, K1, B = 10, 1.2, 0.75
SHARD_WORDS, BLOCK = 5_000_000, 64
COMMON = 16  # words of one document in so many are kept in a dense table
BATCH = 256  # queries that meet the dense table at once
FEW = 16  # documents that are scored one by one
POSTING = np.dtype([("weight", np.float32), ("row", np.uint32)])
QUERY_PAIRS = 2_000_000
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_NORMAL = bytes(32 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_NO_ID = (1 << 63) - 1

SHARD = ("docs long, words long, ids binary, lengths binary, terms binary, starts binary, "
         "rows binary, rows_type string, counts binary, counts_type string")


def text_words(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the words of each text, in order."""
    out: list[np.ndarray] = []
    for a, b in pieces(texts):
        hashes, firsts = word_hashes([(t or "").encode().translate(_NORMAL) for t in texts[a:b]])
        out += [hashes[x:y] for x, y in zip(firsts[:-1], firsts[1:], strict=True)]
    return out


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint16 if not len(x) or x.max() < 1 << 16 else np.uint32)


def build_shard(ids: list[int | None], words: list[np.ndarray]) -> dict:
    lengths = np.array([len(w) for w in words], np.int64)
    known = np.array([_NO_ID if i is None else i for i in ids], np.int64)
    order = np.lexsort((known, lengths))
    terms = np.concatenate([words[i] for i in order])
    rows = np.repeat(np.arange(len(order)), lengths[order])
    by = np.lexsort((rows, terms))
    terms, rows = terms[by], rows[by]
    new = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (rows[1:] != rows[:-1])]))
    counts = np.diff(np.append(new, len(terms)))
    terms, rows = terms[new], rows[new]
    first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    rows, counts = _small(rows), _small(counts)
    return {"docs": len(order), "words": int(lengths.sum()), "ids": known[order].tobytes(),
            "lengths": lengths[order].tobytes(), "terms": terms[first].tobytes(),
            "starts": np.append(first, len(terms)).astype(np.int64).tobytes(), "rows": rows.tobytes(),
            "rows_type": rows.dtype.str, "counts": counts.tobytes(), "counts_type": counts.dtype.str}


def build(docs: DataFrame) -> DataFrame:
    """The stored shards of (doc_id, text)."""
    columns = [c.split(" ")[0] for c in SHARD.split(", ")]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, size = [], [], 0

        def made() -> pa.RecordBatch:
            shard = build_shard(ids, words)
            return pa.RecordBatch.from_arrays([pa.array([shard[c]]) for c in columns], columns)

        for batch in batches:
            for doc_id, found in zip(batch.column(0).to_pylist(), text_words(batch.column(1).to_pylist()), strict=True):
                if len(found):
                    ids.append(doc_id)
                    words.append(found.copy())
                    size += len(found)
                if size >= SHARD_WORDS:
                    yield made()
                    ids, words, size = [], [], 0
        if ids:
            yield made()

    return store(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(shards, SHARD),
                 "search-shards")


def weighted_queries(queries: DataFrame, shards: DataFrame, n_docs: int) -> DataFrame:
    """(query_id, terms, weights): distinct words of each query, ascending, times their inverse frequency."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [np.unique(w, return_counts=True) for w in text_words(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(ids, np.int64), [len(f[0]) for f in found])),
                 pa.array(np.concatenate([*(f[0] for f in found), np.zeros(0, np.uint64)]).view(np.int64)),
                 pa.array(np.concatenate([*(f[1] for f in found), np.zeros(0, np.int64)]))], ["query_id", "term", "n"])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, starts in zip(batch.column(0), batch.column(1), strict=True):
                terms, starts = (np.frombuffer(x.as_buffer(), np.int64) for x in (terms, starts))
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(np.diff(starts))], ["term", "df"])

    asked = store(queries.select("query_id", "text").mapInArrow(pairs, "query_id long, term long, n long"), "search-pairs")
    df = (
        shards.select("terms", "starts").mapInArrow(frequencies, "term long, df long")
        .join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    )
    idf = F.ln(1 + (F.lit(float(n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    one = F.struct("term", (F.col("n") * idf).alias("weight"))
    return asked.join(df, "term").groupBy("query_id").agg(F.sort_array(F.collect_list(one)).alias("w")).select(
        "query_id", F.col("w.term").alias("terms"), F.col("w.weight").alias("weights"))


class Queries:
    """Weighted queries, one after the other: the place of each word in ``terms``, all words in order, and its weight."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        self.ids, self.starts, self.weights = ids, starts, weights
        self.terms, places = np.unique(terms.view(np.uint64), return_inverse=True)
        self.places = places.astype(np.int32)


class Shard:
    """A shard ready for searching."""

    def __init__(self, row: dict, mean_words: float, k1: float = K1, b: float = B):
        self.ids = np.frombuffer(row["ids"], np.int64)
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.starts = np.frombuffer(row["starts"], np.int64)
        rows = np.frombuffer(row["rows"], row["rows_type"])
        counts = np.frombuffer(row["counts"], row["counts_type"]).astype(np.float64)
        norm = k1 * (1 - b + b * lengths / mean_words)
        weights = counts * (k1 + 1) / (counts + norm[rows])
        # row and weight side by side, as numbers of eight bytes
        postings = np.empty(len(rows), POSTING)
        postings["row"], postings["weight"] = rows, weights
        self.postings = postings.view(np.uint64)
        sizes = np.diff(self.starts)
        # postings by document, in the order of the words, so equal documents of all shards get equal sums
        by_doc = np.argsort(rows, kind="stable")
        self.doc_terms = np.repeat(np.arange(len(self.terms), dtype=np.int32), sizes)[by_doc]
        self.doc_weights = weights[by_doc]
        self.doc_starts = np.append(0, np.cumsum(np.bincount(rows, minlength=len(self.ids))))
        # words of many documents: a dense table of weights, of at most ``COMMON`` times the postings
        often = np.flatnonzero(sizes * COMMON >= len(self.ids))
        self.common = np.full(len(self.terms), -1, np.int32)
        self.common[often] = np.arange(len(often))
        self.table = np.zeros((len(often), len(self.ids)), np.float32)
        for i, (x, y) in enumerate(zip(self.starts[often], self.starts[often + 1], strict=True)):
            self.table[i, rows[x:y]] = weights[x:y]
        self.table_most = np.maximum.reduceat(self.table, np.arange(0, len(self.ids), BLOCK), axis=1)
        # sums of positive single numbers are exact up to this share
        self.share = (len(often) + 8) * 2.0 ** -23
        self.asked = np.zeros(len(self.terms))

    def scores(self, docs: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The exact scores of the documents."""
        self.asked[at] = weights
        places, which = ranges(self.doc_starts[docs], self.doc_starts[docs + 1])
        found = np.bincount(which, self.asked[self.doc_terms[places]] * self.doc_weights[places], len(docs))
        self.asked[at] = 0
        return found

    def search(self, queries: Queries, k: int, best: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Puts the k best (scores, ids) of this shard and ``best`` of each query into ``best``."""
        at = np.searchsorted(self.terms, queries.terms)
        at[at == len(self.terms)] = 0
        at[self.terms[at] != queries.terms] = -1
        for begin in range(0, len(queries.ids), BATCH):
            self._search(queries, range(begin, min(begin + BATCH, len(queries.ids))), at, k, best)

    def _search(self, queries: Queries, batch: range, places: np.ndarray, k: int, best: list) -> None:
        left = []
        for q in batch:
            part = slice(queries.starts[q], queries.starts[q + 1])
            at = places[queries.places[part]]
            here = at >= 0
            at, weights = at[here], queries.weights[part][here]
            if not len(at):
                continue
            common = self.common[at]
            dense = common >= 0
            rare, common, weight = at[~dense], common[dense], weights[dense]
            # scores by rare words; the bound of a block by common words says which blocks can reach the k-th score
            scores = np.zeros(len(self.ids))
            if len(rare):
                first, last = self.starts[rare], self.starts[rare + 1]
                met = np.concatenate([self.postings[x:y] for x, y in zip(first.tolist(), last.tolist(), strict=True)]).view(POSTING)
                scores = np.bincount(met["row"], met["weight"] * np.repeat(weights[~dense], last - first), len(self.ids))
            bounds = scores + np.repeat(weight @ self.table_most[common], BLOCK)[:len(self.ids)]
            least = best[q][0][k - 1] if len(best[q][0]) >= k else 0.0
            docs = np.flatnonzero((bounds * (1 + self.share) >= least) & (bounds > 0))
            if len(docs) <= FEW:
                self._add(best, q, docs, at, weights, k)
            else:
                left.append((q, docs, at, weights, common, weight, scores, least))
        if not left:
            return
        asked = np.zeros((len(left), len(self.table)), np.float32)
        for i, (_, _, _, _, common, weight, _, _) in enumerate(left):
            asked[i, common] = weight
        for (q, docs, at, weights, _, _, scores, least), found in zip(left, asked @ self.table, strict=True):
            scores = (scores + found)[docs]
            # the k-th of these scores, less what they may be wrong by, is reached by k documents
            if len(docs) > k:
                least = max(least, np.partition(scores, -k)[-k] * (1 - self.share))
            self._add(best, q, docs[(scores * (1 + self.share) >= least) & (scores > 0)], at, weights, k)

    def _add(self, best: list, q: int, docs: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int) -> None:
        if len(docs):
            scores = np.concatenate([best[q][0], self.scores(docs, at, weights)])
            ids = np.concatenate([best[q][1], self.ids[docs]])
            order = np.lexsort((ids, -scores))[:k]
            order = order[scores[order] > 0]
            best[q] = scores[order], ids[order]


def search(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each query (query_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    shards = build(docs)
    total = shards.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    schema = "query_id long, doc_id long, score double"
    if not total.docs:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    asked = store(weighted_queries(queries.where("query_id IS NOT NULL").groupBy("query_id").agg(F.min("text").alias("text")), shards, total.docs),
                  "search-queries")
    n_pairs = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = -(-n_pairs // QUERY_PAIRS)
    mean_words = total.words / total.docs
    columns = [c.split(" ")[0] for c in SHARD.split(", ")]
    # few long tasks: each keeps its k-th scores from shard to shard and sends k rows a query
    n_tasks = 2 * spark.sparkContext.defaultParallelism
    parts = []
    for i in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == i).toArrow().combine_chunks()
        terms, weights = (pa.concat_arrays(rows[c].chunks or [pa.array([], rows[c].type)]) for c in ("terms", "weights"))
        starts = np.append(0, np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False)))
        block = spark.sparkContext.broadcast(Queries(
            rows["query_id"].to_numpy(), starts, terms.flatten().to_numpy(), weights.flatten().to_numpy()))

        def find(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            none = np.zeros(0), np.zeros(0, np.int64)
            best = [none] * len(block.value.ids)
            for batch in batches:
                for r in range(batch.num_rows):
                    shard = Shard({c: batch.column(j)[r].as_py() for j, c in enumerate(columns)}, mean_words)
                    shard.search(block.value, k, best)
            sizes = [len(b[0]) for b in best]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(block.value.ids, sizes)),
                 pa.array(np.concatenate([*(b[1] for b in best), none[1]])),
                 pa.array(np.concatenate([*(b[0] for b in best), none[0]]))], ["query_id", "doc_id", "score"])

        parts.append(store(shards.coalesce(n_tasks).mapInArrow(find, schema), "search-found"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif(F.col("doc_id"), F.lit(_NO_ID)).alias("doc_id"), "score")


def op5_search(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return search(docs, docs.where(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("query_id"), "text"))
