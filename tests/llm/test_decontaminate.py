import random
import re

from opsledger.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    words, hit, owners = low(text), set(), set()
    for item_id, item in items:
        item = low(item)
        n = min(10, len(item))
        for i in range(len(item) - n + 1 if n else 0):
            for p in range(len(words) - n + 1):
                if words[p:p + n] == item[i:i + n]:
                    hit.update(range(p, p + n))
                    owners.add(str(item_id))
    return len(words), len(hit), sorted(owners)


def test_hits_equal_brute_force(spark):
    r = random.Random(3)
    items = [(i, " ".join(r.choice("ab cd éf gh".split()) for _ in range(r.choice([0, 1, 3, 9, 10, 12, 25])))) for i in range(12)]
    items += [(20, None), (None, "Only, HERE"), (21, items[5][1]), (22, items[5][1].upper())]
    docs = [(i, " ".join(r.choice(["ab", "CD", "éf", "gh", "x-y", "."]) for _ in range(r.choice([0, 5, 40])))) for i in range(25)]
    docs += [(100, None), (101, "only here; and Only\nHere"), (102, (items[11][1] + " zz ") * 3), (102, "only here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    owned = [("" if i is None else i, t) for i, t in items]
    for limit in (decontaminate.BLOCK_CHARS, 40):  # one automaton, and many
        got = frame.select("doc_id", "text", decontaminate.scanned(frame["text"], bench, limit=limit).alias("s")).collect()
        for row in got:
            n_words, n_hit, owners = brute(row.text, owned)
            ranges = list(zip(row.s.hits[::2], row.s.hits[1::2], strict=True))
            assert (row.s.n_words, sum(b - a for a, b in ranges), list(row.s["items"])) == (n_words, n_hit, owners)
            spans = [low(row.text[s.start:s.end]) for s in row.s.spans]
            assert spans == [low(row.text)[a:b] for a, b in ranges]


def test_messy_and_empty(spark, messy, nothing):
    bench = spark.createDataFrame([(1, "one two"), (2, "x " * 30)], "item_id long, text string")
    got = decontaminate.clean(messy, bench)
    assert got.columns == messy.columns
    assert {r.doc_id for r in messy.select("doc_id").subtract(got.select("doc_id")).collect()} == {9}
    assert decontaminate.clean(nothing, bench).count() == 0
    assert decontaminate.clean(messy, bench.limit(0)).count() == messy.count()
