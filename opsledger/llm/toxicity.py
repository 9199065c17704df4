"""Toxicity by nearest labelled examples: exact TF-IDF cosine over inverted indexes, weighted votes.

A text has two votes. The first compares whole texts: the lower-case words of the examples span the space, document
frequencies are counted over all documents, and the ``K`` examples with the largest cosine vote with the odds
cosine ** 2 / (1 - cosine ** 2), so a near copy outvotes texts that share only common words. All cosines are computed:
the postings of most words, and a dense block for the ``COMMON`` words most examples have. The second looks closer at
terms that go with the label, words and their beginnings of ``PREFIXES`` letters that pass a likelihood-ratio test over
the examples, corrected for the number of terms tried. Its index cuts postings into blocks of ``BLOCK`` examples with
the largest weight of each term in each block; blocks are scored from the largest bound down until no bound reaches the
k-th cosine, so these nearest examples are exact too. Without such terms this vote is 0 and the first one stands alone.

Both votes are turned into a probability by a logistic curve. It is fitted to every example twice: without its own vote,
as a new text, and with its own vote among whole texts, as a copy.

The classifier is fitted on at most ``MAX_EXAMPLES`` labelled rows (those with the smallest hashed ids). Their texts
bound the words, known by 64-bit hashes; at most ``MAX_TERMS`` terms go with the label. One task fits the model from the
sample; the driver passes its arrays on as a broadcast.

Defined cases: null and empty texts, and texts without words of the examples, get the score of no votes; labels
without a document, null labels and null ids are left out; a document with several labels counts as toxic if one says so; without
toxic examples every score is the share of toxic labels (0 without labels); ties between examples go to the smaller
id; repeated rows are scored alike; an empty table gives no rows. Extra columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from .shared import bucket_of_id, opened, shipped, small_batches, store, table
from .shingles import ranges

MAX_EXAMPLES = 16_384
MAX_TERMS = 4096
PREFIXES = (3, 4, 5, 6, 7)
LEAST_TOXIC = 3
FALSE_TERMS = 0.01  # expected number of terms chosen by chance
BLOCK, FIRST_BLOCKS = 128, 16
K = 15
PRIOR_VOTE = 0.5
THRESHOLD = 0.3
EVIDENCE = 5
COMMON, TEXTS = 256, 64
GROUP, ROW = 64, (1 << 32) - 1
MARGIN = 1e-5  # larger than the rounding of single-precision cosines
COUNT_BLOCKS = 32
CACHE_WORDS = 50_000
COUNTED_TERMS = 200_000
PART_BYTES = 4 << 20

_WORD = re.compile(r"[^\W\d_]+")
_BREAKS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def word_terms(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) >= n)]


def words_of(text: str | None) -> list[str]:
    """What ``_WORD`` finds in the lower-case text: cut at ASCII characters first, the rest is searched only if it has to be."""
    data = (text or "").lower().encode("utf-8", "surrogatepass")
    words = data.translate(_BREAKS).decode("utf-8", "surrogatepass").split()
    if all(map(str.isalpha, words)):
        return words
    return [x for w in words for x in ((w,) if w.isalpha() else _WORD.findall(w))]


def text_terms(text: str | None) -> set[str]:
    return set().union(*map(word_terms, set(words_of(text))))


def hashes(words: Iterable[str], n: int) -> np.ndarray:
    return np.fromiter((xxh3_64_intdigest(w) for w in words), np.uint64, n)


class Vectors:
    """Counts of the examples' words and of the label's terms in texts.

    The examples' words are a sorted array of 64-bit hashes. About ``CACHE_WORDS`` words keep their place, found once. An
    example's word that turned out to have none of the terms is passed over from then on; others are looked up.
    """

    def __init__(self, known: tuple[np.ndarray, dict[str, int]]):
        self.words, self.terms = known
        self.places: dict[str, int] = {}
        self.plain = np.zeros(len(self.words), bool)
        self.known: dict[str, list[int]] = {}
        self.heads = {t[:3] for t in self.terms}

    def found(self, bags: list[Counter]) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[dict[int, int]]]:
        """Per bag of words the numbers of those that examples have, with their counts, and the terms with theirs."""
        terms: list[dict[int, int]] = [{} for _ in bags]
        if not len(self.words):
            return [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(bags), terms
        words = list(chain.from_iterable(bags))
        counts = np.fromiter(chain.from_iterable(bag.values() for bag in bags), np.int64, len(words))
        place = np.fromiter(map(self.places.get, words, repeat(-2)), np.int64, len(words))
        new = np.flatnonzero(place == -2)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            found = hashes(fresh, len(fresh))
            at = np.minimum(np.searchsorted(self.words, found), len(self.words) - 1)
            at[self.words[at] != found] = -1
            place[new] = at
            if len(self.places) < CACHE_WORDS:
                self.places.update(zip(fresh, at.tolist(), strict=True))
        hit = place >= 0
        ends = np.cumsum([0, *map(len, bags)])
        open_ = np.flatnonzero(~hit | ~self.plain[place]) if self.terms else new[:0]
        of = np.searchsorted(ends, open_, "right") - 1
        for i, mine, at in zip(open_.tolist(), of.tolist(), place[open_].tolist(), strict=True):
            ids = self._terms_of(words[i])
            if not ids and at >= 0:
                self.plain[at] = True
            for t in ids:
                terms[mine][t] = terms[mine].get(t, 0) + int(counts[i])
        return [(place[a:b][hit[a:b]], counts[a:b][hit[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)], terms

    def _terms_of(self, word: str) -> list[int]:
        if (word[:3] if len(word) > 2 else word + "$") not in self.heads:
            return []
        ids = self.known.get(word)
        if ids is None:
            ids = [self.terms[t] for t in word_terms(word) if t in self.terms]
            if len(self.known) < CACHE_WORDS:
                self.known[word] = ids
        return ids


def bag_of(text: str | None) -> Counter:
    return Counter(words_of(text))


def weigh(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term ids and weights of length one."""
    return weigh_arrays(np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts)), idf)


def weigh_arrays(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids)
    ids, weights = ids[order], (1 + np.log(counts[order])) * idf[ids[order]]
    return ids, weights / np.sqrt((weights ** 2).sum()) if len(ids) else weights


class BlockMaxIndex:
    """Exact nearest examples by inner product of unit vectors."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.block, self.n = block, len(vectors)
        self.n_blocks = -(-self.n // block)
        rows = np.repeat(np.arange(self.n), [len(v[0]) for v in vectors])
        terms = np.concatenate([*(v[0] for v in vectors), np.zeros(0, np.int64)])
        weights = np.concatenate([*(v[1] for v in vectors), np.zeros(0)])
        order = np.lexsort((rows, terms))
        self.rows, self.weights = rows[order], weights[order]
        cell = terms[order] * self.n_blocks + self.rows // block
        self.starts = np.searchsorted(cell, np.arange(n_terms * self.n_blocks + 1))
        self.most = np.zeros(n_terms * self.n_blocks)
        np.maximum.at(self.most, cell, self.weights)
        self.most = self.most.reshape(n_terms, self.n_blocks)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int, without: int | None = None):
        """(rows, cosines) of the k largest positive cosines; ties go to the smaller row."""
        if not len(ids) or not self.n:
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = weights @ self.most[ids]
        order = np.argsort(-bounds, kind="stable")
        rows, values, begin, n = np.zeros(0, np.int64), np.zeros(0), 0, FIRST_BLOCKS
        while begin < self.n_blocks:
            chosen = order[begin:begin + n]
            least = values[-1] - 1e-12 if len(rows) == k else 0.0
            chosen = chosen[(bounds[chosen] >= least) & (bounds[chosen] > 0)]
            if not len(chosen):
                break
            cells = (ids[:, None] * self.n_blocks + chosen[None, :]).ravel()
            postings, cell = ranges(self.starts[cells], self.starts[cells + 1])
            scores = np.bincount(self.rows[postings], weights[cell // len(chosen)] * self.weights[postings], self.n)
            if without is not None:
                scores[without] = 0
            found = np.flatnonzero(scores > 0)
            rows, values = np.concatenate([rows, found]), np.concatenate([values, scores[found]])
            if len(values) > k:
                near = values >= np.partition(values, len(values) - k)[len(values) - k]
                rows, values = rows[near], values[near]
            best = np.lexsort((rows, -values))[:k]
            rows, values = rows[best], values[best]
            begin, n = begin + n, n * 2
        return rows, values


def below_kth(values: np.ndarray, k: int) -> float:
    """A bound that at least ``k`` of the values reach, from the largest of every ``GROUP``; 0 for few values."""
    n = len(values) // GROUP
    if n <= k:
        return 0.0
    largest = values[:n * GROUP].reshape(GROUP, n).max(axis=0)
    return float(np.partition(largest, n - k)[n - k])


class WordIndex:
    """Exact nearest examples by inner product, for vectors of many words, several texts at once."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_words: int, common: int = COMMON):
        self.n = len(vectors)
        rows = np.repeat(np.arange(self.n, dtype=np.int32), [len(v[0]) for v in vectors])
        words = np.concatenate([*(v[0] for v in vectors), np.zeros(0, np.int32)]).astype(np.int32)
        weights = np.concatenate([*(v[1].astype(np.float32) for v in vectors), np.zeros(0, np.float32)])
        sizes = np.bincount(words, minlength=n_words)
        often = np.argsort(-sizes, kind="stable")[:common]
        self.place = np.full(n_words, -1, np.int32)
        self.place[often] = np.arange(len(often))
        dense = self.place[words] >= 0
        self.dense = np.zeros((self.n, len(often)), np.float32)
        self.dense[rows[dense], self.place[words[dense]]] = weights[dense]
        rows, words, weights = rows[~dense], words[~dense], weights[~dense]
        order = np.argsort(words, kind="stable")
        # row and weight of a posting lie side by side, so a word's postings are fetched at once
        self.postings = np.empty(len(order), np.int64)
        self.postings.view(np.int32)[::2], self.postings.view(np.float32)[1::2] = rows[order], weights[order]
        self.starts = np.searchsorted(words[order], np.arange(n_words + 1))

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None):
        """Per text (rows, cosines) of the k largest positive cosines; ties go to the smaller row."""
        often = np.zeros((len(texts), self.dense.shape[1]))
        for t, (ids, weights) in enumerate(texts):
            mine = self.place[ids] >= 0
            often[t, self.place[ids[mine]]] = weights[mine]
        near = often.astype(np.float32) @ self.dense.T
        out, steps, room = [], np.zeros(0, np.int64), np.zeros(0, np.int64)  # arrays that all texts use
        for t, (ids, weights) in enumerate(texts):
            mine = self.place[ids] < 0
            begins = self.starts[ids[mine]]
            sizes = self.starts[ids[mine] + 1] - begins
            at, rest = np.repeat(begins - np.cumsum(sizes) + sizes, sizes), np.repeat(weights[mine], sizes)
            if len(at) > len(steps):
                steps = np.arange(2 * len(at))
                room = np.empty_like(steps)
            at += steps[:len(at)]
            found = self.postings.take(at, out=room[:len(at)], mode="clip")
            rest *= found.view(np.float32)[1::2]
            found &= ROW
            rest = np.bincount(found, rest, self.n)
            about = near[t] + rest
            if without is not None:
                about[without[t]] = -1
            least = below_kth(about, k) - MARGIN
            rows = np.flatnonzero(about >= least if least > 0 else about > 0)
            if len(rows) > k:
                near_k = about[rows]
                rows = rows[near_k >= np.partition(near_k, len(rows) - k)[len(rows) - k] - MARGIN]
            values = rest[rows] + self.dense[rows].astype(np.float64) @ often[t]
            best = np.lexsort((rows, -values))[:k]
            out.append((rows[best], np.minimum(values[best], 1.0)))
        return out


WORD_FIELDS = ("place", "dense", "postings", "starts")
BLOCK_FIELDS = ("rows", "weights", "starts", "most")


@dataclass
class Model:
    terms: tuple[np.ndarray, dict[str, int]]  # hashes of the examples' words, and the label's terms
    word_idf: np.ndarray
    idf: np.ndarray
    words: WordIndex | None
    index: BlockMaxIndex | None
    toxic: np.ndarray
    ids: np.ndarray
    slopes: np.ndarray
    offset: float

    def word_vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """The vote of the examples whose whole texts are nearest."""
        votes = cosines ** 2 / (1.001 - cosines ** 2)
        return float((votes * self.toxic[rows]).sum() / (votes.sum() + PRIOR_VOTE))

    def own_word_votes(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Votes of the nearest for each example: without itself, and with itself."""
        out = np.zeros((2, len(texts)))
        for at in range(0, len(texts), TEXTS):
            part = list(range(at, min(at + TEXTS, len(texts))))
            for i, (rows, cosines) in zip(part, self.words.nearest(texts[at:at + TEXTS], K, part), strict=True):
                out[0, i] = self.word_vote(rows, cosines)
                own = float(len(texts[i][0]) > 0)
                out[1, i] = self.word_vote(np.append(i, rows[:K - 1]), np.append(own, cosines[:K - 1]))
        return out

    def vote(self, ids: np.ndarray, weights: np.ndarray, without: int | None = None) -> tuple[float, np.ndarray]:
        if self.index is None:
            return 0.0, np.zeros(0, np.int64)
        rows, cosines = self.index.nearest(ids, weights, K, without)
        votes = cosines ** 2
        return float((votes * self.toxic[rows]).sum() / (votes.sum() + PRIOR_VOTE)), rows

    def scores(self, vectors: Vectors, texts: list[str | None]) -> list[tuple[float, list[int]]]:
        out = []
        for at in range(0, len(texts), TEXTS):
            out += self._scores(vectors, [bag_of(t) for t in texts[at:at + TEXTS]])
        return out

    def _scores(self, vectors: Vectors, bags: list[Counter]) -> list[tuple[float, list[int]]]:
        none = np.zeros(0, np.int64)
        whole, terms = vectors.found(bags)
        if self.words:
            whole = self.words.nearest([weigh_arrays(*v, self.word_idf) for v in whole], K)
        else:
            whole = [(none, none)] * len(bags)
        out = []
        for (rows, cosines), found in zip(whole, terms, strict=True):
            by_words = self.word_vote(rows, cosines)
            by_terms, closer = self.vote(*weigh(found, self.idf)) if found else (0.0, [])
            rows = closer if len(closer) else rows
            p = 1 / (1 + np.exp(-(self.slopes @ (by_words, by_terms) + self.offset)))
            out.append((float(p), [int(self.ids[r]) for r in rows[:EVIDENCE]]))
        return out

    def arrays(self) -> dict[str, np.ndarray]:
        """Everything but the terms as named arrays, without copies."""
        out = {f: getattr(self, f) for f in ("word_idf", "idf", "toxic", "ids", "slopes")}
        out |= {"vocabulary": self.terms[0], "offset": np.array([self.offset])}
        for name, index, fields in (("words", self.words, WORD_FIELDS), ("index", self.index, BLOCK_FIELDS)):
            if index is not None:
                out |= {f"{name}.{f}": getattr(index, f) for f in fields}
        return out

    @staticmethod
    def of(arrays: dict[str, np.ndarray], terms: dict[str, int]) -> Model:
        """The model over the given arrays, which it does not copy."""
        found = {}
        for name, kind, fields in (("words", WordIndex, WORD_FIELDS), ("index", BlockMaxIndex, BLOCK_FIELDS)):
            found[name] = None
            if f"{name}.{fields[0]}" in arrays:
                made = found[name] = kind.__new__(kind)
                for f in fields:
                    setattr(made, f, arrays[f"{name}.{f}"])
                made.n = len(arrays["ids"])
        if found["index"] is not None:
            found["index"].block, found["index"].n_blocks = BLOCK, -(-len(arrays["ids"]) // BLOCK)
        return Model((arrays["vocabulary"], terms), arrays["word_idf"], arrays["idf"], found["words"], found["index"], arrays["toxic"],
                     arrays["ids"], arrays["slopes"], float(arrays["offset"][0]))

    def score(self, vectors: Vectors, text: str | None) -> tuple[float, list[int]]:
        return self.scores(vectors, [text])[0]


def calibrate(votes: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and offset of a logistic curve, by Newton's method with smoothed targets and a slight penalty."""
    up = toxic.sum()
    target = np.where(toxic > 0, (up + 1) / (up + 2), 1 / (len(toxic) - up + 2))
    x, at = np.column_stack([votes, np.ones(len(votes))]), np.zeros(votes.shape[1] + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ at))
        slope = x.T @ (p - target) + 1e-3 * at
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(at))
        step = np.linalg.solve(curve, slope)
        at = at - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return np.maximum(at[:-1], 0.0), float(at[-1])


def examples(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, toxic, text) of at most ``limit`` labelled documents that may be learned from."""
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(bucket_of_id(F.col("doc_id"), 4) != 2)
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    # only labels that have a document count
    ids = docs.select("doc_id").distinct().join(known, "doc_id")
    chosen = store(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit), "toxicity-chosen")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL")
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def choose_terms(known: DataFrame, toxic: int, clean: int) -> dict[str, int]:
    """The terms that go with the label, at most ``MAX_TERMS``, from the examples' texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = (Counter(), Counter())

        def made() -> Iterator[pa.RecordBatch]:
            for side, counts in enumerate(sides):
                terms, found = pa.array(list(counts), pa.string()), np.fromiter(counts.values(), np.int64, len(counts))
                zero = np.zeros(len(counts), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [terms, *(pa.array(found if side == s else zero) for s in (0, 1))], ["term", "clean", "toxic"])
                counts.clear()

        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sides[1 if label else 0].update(text_terms(text))
                if sum(map(len, sides)) > COUNTED_TERMS:
                    yield from made()
        yield from made()

    each = known.select("toxic", "text").mapInArrow(count, "term string, clean long, toxic long")
    sums = store(each.groupBy("term").agg(F.sum("clean").alias("n"), F.sum("toxic").alias("p")), "toxicity-terms")
    tried = max(sums.where(F.col("n") + F.col("p") >= LEAST_TOXIC).count(), 1)
    limit = 2 * (np.log(tried) - np.log(FALSE_TERMS))  # chance of a larger ratio is about exp(-ratio / 2)
    share = toxic / (toxic + clean)
    n, p, all_ = F.col("n").cast("double"), F.col("p").cast("double"), (F.col("n") + F.col("p")).cast("double")
    ratio = 2 * (p * F.ln(p / (all_ * share)) + F.when(n > 0, n * F.ln(n / (all_ * (1 - share)))).otherwise(0.0))
    best = (
        sums.where(F.col("p") >= LEAST_TOXIC).withColumn("ratio", ratio)
        .where((F.col("ratio") >= float(limit)) & (p / toxic > 3 * n / max(clean, 1)))
        .orderBy(F.desc("ratio"), "term").limit(MAX_TERMS)
    )
    return {row.term: i for i, row in enumerate(best.select("term").collect())}


def frequencies(docs: DataFrame, terms: tuple[np.ndarray, dict[str, int]]) -> tuple[int, np.ndarray]:
    """The number of documents, and in how many of them each word and then each term stands."""
    n_words = len(terms[0])
    n = n_words + len(terms[1])
    each = -(-n // COUNT_BLOCKS)
    parcel = shipped(docs.sparkSession, terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, seen, total = Vectors(opened(parcel)), np.zeros(n, np.int32), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for at in range(0, len(texts), TEXTS):
                for (ids, _), found in zip(*vectors.found([bag_of(t) for t in texts[at:at + TEXTS]]), strict=True):
                    seen[ids] += 1
                    seen[[n_words + i for i in found]] += 1
            total += len(texts)
        if total:
            parts = [seen[i * each:(i + 1) * each].tobytes() for i in range(COUNT_BLOCKS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([*range(COUNT_BLOCKS), -1], pa.int32()),
                 pa.array([*parts, np.array([total], np.int32).tobytes()], pa.binary())], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(data, np.int32).astype(np.int64)
        for i, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([counts.tobytes()], pa.binary())],
                                             ["block", "counts"])

    schema = "block int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema).repartition(COUNT_BLOCKS, "block").mapInArrow(add, schema)
    sums = {r.block: np.frombuffer(r.counts, np.int64) for r in parts.collect()}
    return int(sums[-1][0]), np.concatenate([sums[i] for i in range(COUNT_BLOCKS)])


def vocabulary(known: DataFrame) -> np.ndarray:
    """Sorted hashes of all words of the examples' texts; the sample of examples bounds them."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set().union(*[bag_of(t) for t in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(hashes(seen, len(seen)).view(np.int64))], ["h"])

    found = known.select("text").mapInArrow(words, "h long").distinct().toArrow().column("h").to_numpy()
    return np.sort(found.view(np.uint64))


def _fitted(known: DataFrame, parcel) -> DataFrame:
    """(head, part, data): the model's arrays in parts, fitted by one task from the bounded sample of examples."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (words, terms), total, seen = opened(parcel)
        vectors = Vectors((words, terms))
        idf = np.log((total + 1) / (seen + 1)) + 1
        word_idf, idf = idf[:len(words)].astype(np.float32), idf[len(words):]
        ids, marks, whole, found = [], [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            marks += [float(t > 0) for t in batch.column(1).to_pylist()]
            texts = batch.column(2).to_pylist()
            for at in range(0, len(texts), TEXTS):
                words_, terms_ = vectors.found([bag_of(t) for t in texts[at:at + TEXTS]])
                for v in words_:
                    places, weights = weigh_arrays(*v, word_idf)
                    whole.append((places.astype(np.int32), weights.astype(np.float32)))
                found += [weigh(f, idf) for f in terms_]
        marks = np.array(marks)
        model = Model((words, terms), word_idf, idf, WordIndex(whole, len(words)),
                      BlockMaxIndex(found, len(terms)) if terms else None, marks, np.array(ids), np.zeros(2), 0.0)
        by_terms = np.array([model.vote(*v, without=i)[0] for i, v in enumerate(found)])
        votes = np.concatenate([np.column_stack([v, by_terms]) for v in model.own_word_votes(whole)])
        model.slopes, model.offset = calibrate(votes, np.tile(marks, 2))
        del whole, found, vectors
        for name, array in model.arrays().items():
            head, data = f"{name} {array.dtype.str} {','.join(map(str, array.shape))}", array.tobytes()
            for i in range(0, max(len(data), 1), PART_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array([head]), pa.array([i // PART_BYTES], pa.int32()),
                                                  pa.array([data[i:i + PART_BYTES]], pa.binary())], ["head", "part", "data"])

    return known.coalesce(1).sortWithinPartitions("doc_id").select("doc_id", "toxic", "text").mapInArrow(work, "head string, part int, data binary")


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES) -> Model:
    return Model.of(*fitted(docs, labels, limit))


def fitted(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES) -> tuple[dict[str, np.ndarray], dict[str, int]]:
    """Arrays and terms of the :class:`Model`. The driver holds these, the examples' word hashes and their counts, no texts."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = store(examples(docs, labels, limit), "toxicity-examples")
    sizes = {r.toxic: r.n for r in known.groupBy(F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"))
             .agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    none = np.zeros(0, np.int64)
    if not toxic or not clean:
        share = min(max(toxic / max(toxic + clean, 1), 1e-6), 1 - 1e-6)
        return Model((none.view(np.uint64), {}), np.zeros(0), np.zeros(0), None, None, none, none, np.zeros(2),
                     float(np.log(share / (1 - share)))).arrays(), {}
    terms = vocabulary(known), choose_terms(known, toxic, clean)
    parcel = shipped(spark, (terms, *frequencies(docs, terms)))
    stored = store(_fitted(known, parcel), "toxicity-model")
    parcel.destroy()
    arrays = {}
    for head, parts in sorted(tuple(r) for r in stored.groupBy("head").agg(F.max("part") + 1).collect()):
        name, kind, shape = head.split(" ")
        # one part at a time: the driver's JVM holds several copies of what it passes on
        data = b"".join(r.data for i in range(parts) for r in stored.where((F.col("head") == head) & (F.col("part") == i)).collect())
        arrays[name] = (np.frombuffer(data, kind) if data else np.zeros(0, kind)).reshape([int(n) for n in shape.split(",")])
    return arrays, terms[1]


def scored(text: Column, model: tuple[dict[str, np.ndarray], dict[str, int]], spark) -> Column:
    """struct<score, evidence>: the probability and the ids of the nearest examples."""
    small_batches(spark)
    parcel = spark.sparkContext.broadcast(model)

    @F.pandas_udf("score double, evidence array<long>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Model.of(*parcel.value)
        vectors = Vectors(known.terms)
        for texts in batches:
            yield pd.DataFrame(known.scores(vectors, texts.tolist()), columns=["score", "evidence"])

    return score(text.cast("string"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, with the columns of ``docs``."""
    model = fitted(docs, labels)
    return docs.where(scored(F.col("text"), model, docs.sparkSession)["score"] < THRESHOLD)


def op2_toxicity(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, folder, "labels").select("doc_id", "toxic"))
    found = docs.select("doc_id", scored(F.col("text"), model, spark).alias("s"))
    return found.select(
        "doc_id", (bucket_of_id(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("s.score").alias("score"),
        (F.col("s.score") >= THRESHOLD).cast("int").alias("predicted"), F.col("s.evidence").alias("evidence"))
