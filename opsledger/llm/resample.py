"""Resampling documents towards a target: hashed word-run features, importance weights, a draw without replacement.

A feature is a run of 1 to ``width`` consecutive words; its bucket is the CRC-32 of its text modulo ``buckets``. The
texts of a piece give one Aho-Corasick dictionary: every distinct word once, with a space on both sides and with its
CRC and length as payload. One scan of the normalised text emits the payloads in order; the CRC of a longer run is
composed from adjacent payloads and never computed from text. The same scan serves both passes: counting the buckets
of all texts, where a task sends at most ``buckets`` sums, and scoring each text by the gains of its buckets.

The draw adds Gumbel noise from a hash of the id to each weight and takes the highest sums, which is sampling without
replacement in proportion to the weights. Ranks are places in a stored range sort; no list meets in one task.

Defined cases: null and empty texts have no words, no features and weight 0; a null doc_id counts as the empty text
in the hash and is last among ties; repeated rows are documents of their own with equal scores and ranks next to each
other; empty tables give no rows, and an empty target leaves every bucket its smoothed gain. Extra columns do not
matter. A dictionary lives for one piece of text (about 1 MB, or one longer text).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsledger.operators.indexing import ordered_positions

from .shared import pieces, small_batches, store, table

WIDTH = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_NORMAL = bytes(32 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_LENGTH_BITS = 31
_POLYNOMIAL = 0xEDB88320


def _zero_bytes() -> list[np.ndarray]:
    """For each k, what 2^k zero bytes do to a CRC, as one table of 256 values per byte of the CRC."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(_POLYNOMIAL), first >> 1)
    values = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
    out = [(values >> 8) ^ first[values & 255]]
    while len(out) < _LENGTH_BITS:
        out.append(_through(out[-1], out[-1]))
    return out


def _through(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24])


_ZERO_BYTES = _zero_bytes()


def composed(left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 of two texts one after the other, from their CRCs and the second one's number of bytes."""
    left = left.astype(np.uint32)
    for k in range(int(right_bytes.max(initial=0)).bit_length()):
        some = (right_bytes >> k) & 1 == 1
        left[some] = _through(_ZERO_BYTES[k], left[some])
    return left ^ right.astype(np.uint32)


def payloads(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC and bytes of every word of the texts in order, and the number of words of each text."""
    normal = [t.encode().translate(_NORMAL).split() if t else [] for t in texts]
    counts = np.array([len(words) for words in normal], np.int64)
    dictionary = ahocorasick.Automaton()
    for word in set().union(*normal):
        dictionary.add_word(f" {word.decode()} ", zlib.crc32(word) << _LENGTH_BITS | len(word))
    found = np.zeros(0, np.int64)
    if len(dictionary):
        dictionary.make_automaton()
        # neighbours share the space between them; matches end in the order of the words
        line = " " + b" ".join(word for words in normal for word in words).decode() + " "
        found = np.fromiter((v for _, v in dictionary.iter(line)), np.int64, int(counts.sum()))
    return (found >> _LENGTH_BITS).astype(np.uint32), found & ((1 << _LENGTH_BITS) - 1), counts


def features(texts: list[str | None], width: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature, the text each belongs to, and the number of words of each text."""
    crc, size, counts = payloads(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    run, found, owners = crc, [crc], [owner]
    blank = np.uint32(zlib.crc32(b" "))
    for n in range(1, width):
        if len(crc) <= n:
            break
        spaced = composed(np.full(len(crc) - n, blank), crc[n:], size[n:])
        run = composed(run[:-1], spaced, size[n:] + 1)
        same = owner[n:] == owner[:-n]
        found.append(run[same])
        owners.append(owner[n:][same])
    return np.concatenate(found).astype(np.int64) % buckets, np.concatenate(owners), counts


def bucket_counts(texts: DataFrame, width: int = WIDTH, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all rows' ``text`` per bucket that has any; at most ``buckets`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            rows = batch.column(0).to_pylist()
            for a, b in pieces(rows):
                sums += np.bincount(features(rows[a:b], width, buckets)[0], minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["bucket", "n"])

    parts = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, width: int = WIDTH, buckets: int = BUCKETS) -> list[int]:
    """Per bucket floor(1000 ln) of the smoothed share in the target over that in the documents."""
    spark = docs.sparkSession
    raw, aim = bucket_counts(docs, width, buckets), bucket_counts(target, width, buckets)
    both = raw.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        aim.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    every = both.unionByName(spark.range(buckets).select(
        F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t")))
    # one row per bucket reaches the driver
    rows = every.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).orderBy("bucket")
    sums = spark.createDataFrame([(r.bucket, float(r.s), float(r.t)) for r in rows.collect()], "bucket long, s double, t double")
    total = sums.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = (F.col("t") + 1) * (total.s + buckets) / ((F.col("s") + 1) * (total.t + buckets))
    return [r.gain for r in sums.orderBy("bucket").select(F.floor(1000 * F.ln(ratio)).alias("gain")).collect()]


def weighed(docs: DataFrame, gain: list[int], width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    table_of_gains = np.array(gain, np.int64)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, parts = batch.tolist(), []
            for a, b in pieces(rows):
                bucket, owner, words = features(rows[a:b], width, len(table_of_gains))
                number = np.bincount(owner, minlength=b - a)
                total = np.zeros(b - a, np.int64)
                np.add.at(total, owner, table_of_gains[bucket])
                parts.append(np.stack([words, number, total // np.maximum(number, 1)], 1))
            yield pd.DataFrame(np.concatenate(parts) if parts else np.zeros((0, 3), np.int64),
                               columns=["n_words", "n_features", "weight"])

    return docs.select("doc_id", weigh(F.col("text").cast("string")).alias("_w")).select("doc_id", "_w.*")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
              width: int = WIDTH, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; rank is null where a row is not drawn.

    Drawn are the highest scores among rows of at least ``least_words`` words, ``percent`` of those rows.
    """
    # stored: the range sort looks at its rows twice
    weights = store(weighed(docs, gains(docs, target, width, buckets), width), "resample-weights")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296)))
    scored = weights.withColumn("score", F.col("weight") + noise).withColumn("_open", F.col("n_words") >= least_words)
    placed = ordered_positions(scored, [F.col("_open").desc(), F.col("score").desc(),
                                        F.col("doc_id").asc_nulls_last(), "weight", "n_features", "n_words"], "_at")
    drawn = placed.agg(F.count_if("_open").alias("n")).first().n * percent // 100
    rank = F.when(F.col("_open") & (F.col("_at") < drawn), F.col("_at") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def op12_resample(spark, folder: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    drawn = resampled(docs, table(spark, folder, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
aims AS (SELECT regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
places AS (SELECT rid, unnest(w) AS word FROM docs),
targets AS (SELECT unnest(w) AS word FROM aims),
steps AS (SELECT list(crc ORDER BY i) AS step FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc FROM range(256) r(i))),
hexed AS (SELECT word, hex(word) AS h FROM (SELECT word FROM places UNION SELECT word FROM targets)),
crcs AS (SELECT word, xor(list_reduce(list_prepend(4294967295, [(instr('0123456789ABCDEF', h[2 * k + 1]) - 1) * 16
        + instr('0123456789ABCDEF', h[2 * k + 2]) - 1 FOR k IN range(len(h) // 2)]),
    lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM hexed, steps),
s AS (SELECT bucket, count(*) AS s FROM places JOIN crcs USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM targets JOIN crcs USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM places) AS all_s, (SELECT count(*) FROM targets) AS all_t),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (all_s + 10000.0::DOUBLE)
    / ((s + 1.0::DOUBLE) * (all_t + 10000.0::DOUBLE)))) AS BIGINT) AS g FROM s LEFT JOIN t USING (bucket), totals),
sums AS (SELECT rid, count(*) AS n, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight
         FROM places JOIN crcs USING (word) JOIN gain USING (bucket) GROUP BY rid),
scored AS (SELECT rid, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8)
    AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM docs LEFT JOIN sums USING (rid)),
ranked AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS r,
    10 * count(*) OVER () // 100 AS k FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= k THEN r END AS rank FROM scored LEFT JOIN ranked USING (rid)
"""
