"""Benchmark decontamination: one Aho-Corasick automaton over the normalised items, one scan per text.

Text is normalised to lower-case (A-Z) words joined by one space. A window is ``WINDOW`` consecutive words of an
item; an item of fewer words is one window. The automaton holds every window with a space on both sides, so matches
begin and end at words. A document word inside any match is hit; hit runs are mapped back to code points of the
original text.

The automaton is built in each task from the item words, which are broadcast. A block of items has at most
``BLOCK_CHARS`` characters of windows; more items make more blocks, and a text then passes one automaton per block
in the same task. Nothing is shuffled.

Defined cases: null and empty texts have no words and no hits; null or empty items have no window; a null item_id
counts as the empty id; equal items are all reported; repeated document rows give equal rows; empty tables give no
rows or no hits. Extra columns do not matter.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .shared import small_batches, table

WINDOW = 10
BLOCK_CHARS = 4_000_000
SCHEMA = "n_words long, hits array<int>, items array<string>, spans array<struct<start:int,end:int>>"

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_NORMAL = bytes(32 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return [w.decode() for w in text.encode().translate(_NORMAL).split()] if text else []


def windows(item: list[str], width: int = WINDOW) -> Iterator[tuple[str, int]]:
    """(window with a space on both sides, number of its words)."""
    n = min(width, len(item))
    for i in range(len(item) - n + 1 if n else 0):
        yield " " + " ".join(item[i:i + n]) + " ", n


def automaton(items: list[tuple[str, list[str]]], width: int) -> ahocorasick.Automaton:
    ids = defaultdict(set)
    for item_id, item in items:
        for window in windows(item, width):
            ids[window].add(item_id)
    made = ahocorasick.Automaton()
    for (window, n), owners in ids.items():
        made.add_word(window, (n, sorted(owners)))
    if ids:
        made.make_automaton()
    return made


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open word ranges, sorted and joined where they meet."""
    out: list[list[int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def scan(made: ahocorasick.Automaton, text: str | None, hits: list[int], items: list[str]) -> tuple:
    """Number of words, hit word ranges (flat), item ids and original spans; earlier hits and items are kept."""
    if not text:
        return 0, [], [], []
    normal = text.encode().translate(_NORMAL).split()
    found, ranges = set(items), list(zip(hits[::2], hits[1::2], strict=True))
    if len(made):
        line = " " + b" ".join(normal).decode() + " "
        matches = [(end, value) for end, value in made.iter(line)]
        if matches:
            order, at = {}, -1
            for i in range(len(normal) + 1):  # the space after word i - 1
                at = line.index(" ", at + 1)
                order[at] = i
            for end, (n, owners) in matches:
                ranges.append((order[end] - n, order[end]))
                found.update(owners)
    ranges = _merge(ranges)
    spans = []
    if ranges:
        places = [m.span() for m in _WORD.finditer(text)]
        spans = [(places[a][0], places[b - 1][1]) for a, b in ranges]
    return len(normal), [x for r in ranges for x in r], sorted(found), spans


def blocks(items: list[tuple[str, list[str]]], width: int, limit: int) -> list[list[tuple[str, list[str]]]]:
    """Runs of items whose windows have at most ``limit`` characters; one larger item stands alone."""
    out, size = [[]], 0
    for item in items:
        n = sum(len(w) for w, _ in windows(item[1], width))
        if out[-1] and size + n > limit:
            out.append([])
            size = 0
        out[-1].append(item)
        size += n
    return out


def scanned(text: Column, bench: DataFrame, width: int = WINDOW, limit: int = BLOCK_CHARS) -> Column:
    """Struct column of ``SCHEMA`` for a text column."""
    spark = bench.sparkSession
    rows = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text").cast("string"))
    items = [(i, words(t)) for i, t in rows.toLocalIterator()]
    column = F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast("array<int>").alias("hits"),
                      F.array().cast("array<string>").alias("items"))
    for block in blocks(sorted(items), width, limit):
        column = _scanner(spark.sparkContext.broadcast(block), width)(text, column["hits"], column["items"])
    return column


def _scanner(block, width: int):
    @F.pandas_udf(SCHEMA)
    def scan_texts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        made = automaton(block.value, width)
        for texts, hits, items in batches:
            rows = [scan(made, t, list(h), list(i)) for t, h, i in zip(texts, hits, items, strict=True)]
            yield pd.DataFrame(rows, columns=["n_words", "hits", "items", "spans"])
    return scan_texts


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents without any hit word, with the columns of ``docs``."""
    small_batches(docs.sparkSession)
    return docs.where(F.size(scanned(F.col("text"), bench)["hits"]) == 0)


def op4_decontaminate(spark, folder: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = docs.select("doc_id", scanned(F.col("text"), table(spark, folder, "benchmark")).alias("s"))
    pairs = F.sequence(F.lit(0), F.size("s.hits") - 1, F.lit(2))
    hit = F.aggregate(pairs, F.lit(0).cast("long"),
                      lambda n, i: n + F.get("s.hits", i + 1) - F.get("s.hits", i))
    n_hit = F.when(F.size("s.hits") > 0, hit).otherwise(F.lit(0).cast("long"))
    return found.select(
        "doc_id", F.col("s.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("s.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("s.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("s.hits") > 0).alias("contaminated"),
    )


SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
           FROM items WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM starts),
lens AS (SELECT DISTINCT n FROM wins),
places AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM docs, lens),
hits AS (SELECT rid, p, n, item_id FROM (SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS win FROM places)
         JOIN wins USING (n, win)),
hit_words AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hits) GROUP BY rid),
hit_items AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""
