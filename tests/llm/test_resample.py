import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from opsledger.llm import resample


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def runs(text, width):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in range(1, width + 1) for i in range(len(w) - n + 1)]


def brute(docs, targets, percent, least, width, buckets, seed):
    def of(feature):
        return zlib.crc32(feature.encode()) % buckets

    s = Counter(of(f) for _, t in docs for f in runs(t, width))
    t = Counter(of(f) for x in targets for f in runs(x, width))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        found = runs(text, width)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
                 for b in map(of, found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(words(text)), len(found), weight, score))
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2], r[1]))
    k = len(order) * percent // 100
    out = [(*r, i + 1 if i < k else None) for i, r in enumerate(order)]
    return sorted(out + [(*r, None) for r in rows if r[1] < least], key=repr)


def some_docs(n=400):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(200)] + ["é", "字字", "x" * 300, "ab", "A1"]
    docs = [(i, r.choice([" ", "; ", "\n\0"]).join(r.choices(vocabulary, k=r.choice([0, 1, 5, 19, 20, 21, 60])))) for i in range(n)]
    return docs + [docs[7], docs[20], docs[20]]


def test_composed_equals_crc_of_joined_text():
    r = random.Random(3)
    pairs = [(r.randbytes(r.randrange(40)), r.randbytes(r.choice([0, 1, 2, 5, 70_000]))) for _ in range(60)]
    got = resample.composed(np.array([zlib.crc32(a) for a, _ in pairs]), np.array([zlib.crc32(b) for _, b in pairs]),
                            np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_buckets_equal_crc_of_every_run():
    texts = [t for _, t in some_docs(60)] + [None, "", "one", "...", "Two words"]
    for width in (1, 2, 3, 5):
        bucket, owner, counts = resample.features(texts, width, 1000)
        assert counts.tolist() == [len(words(t)) for t in texts]
        got = Counter(zip(owner.tolist(), bucket.tolist(), strict=True))
        assert got == Counter((i, zlib.crc32(f.encode()) % 1000) for i, t in enumerate(texts) for f in runs(t, width))


def test_equals_brute_force(spark):
    docs, targets = some_docs(), [t for i, t in some_docs(40) if i % 5 == 0]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    aim = spark.createDataFrame([(t,) for t in targets], "text string")
    for percent, least, width, buckets, seed in ((10, 20, 1, 10_000, 2024), (35, 1, 3, 64, 7)):
        got = resample.resampled(frame, aim, percent, least, width, buckets, seed)
        assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, targets, percent, least, width, buckets, seed)


def test_messy_rows(spark, messy, nothing):
    docs = [(r.doc_id, r.text) for r in messy.collect()]
    targets = [docs[0][1], docs[3][1], None, ""]
    aim = spark.createDataFrame([(t,) for t in targets], "text string")
    got = resample.resampled(messy, aim, percent=50)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, targets, 50, 20, 1, 10_000, 2024)
    assert resample.resampled(nothing, aim).count() == 0
    empty = resample.resampled(messy, aim.limit(0), percent=50)
    assert sorted(map(tuple, empty.collect()), key=repr) == brute(docs, [], 50, 20, 1, 10_000, 2024)
