import re

import pytest

from opsledger.llm import personal

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def brute(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in BASE.items()}


TEXTS = [
    "", None, "mail a.b@c.de or x@y", "a@b.cd_e@x.yz and @a@b.c.d..e", "😀é a@b.co 1.2.3.4.5.6.7.8",
    "1.2.3 256.1.1.1 001.02.3.4 99999999999999999999.1.1.1", "4111 1111-1111 1111 and 4111111111111112",
    "41111111111111111111111111111111 4012888888881881-", "+1 (415) 555-2671. +12 +1--------2 +44 20 7946 0958 ext",
    "+1 (415) 555-2671+1 (415) 555-2672", "a" * 50_000 + "@", "1" * 50_000, "a@" + "b." * 30_000 + "c", "1.1." * 20_000,
    "+1" + " (" * 30_000, "x@y.z" * 300,
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    return {r.doc_id: r for r in personal.find(docs).collect()}


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_base_spans_equal_plain_search(found, i):
    want = brute(TEXTS[i])
    for kind in BASE:
        assert [(s.start, s.end) for s in found[i][kind]] == want[kind], kind


def test_account_numbers_and_context(spark):
    texts = ["IBAN: DE89 3704 0044 0532 0130 00.", "DE88370400440532013000", "pay GB82WEST12345698765432 now", "call +1 415 555 2671"]
    got = personal.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[(s.start, s.end) for s in r.iban] for r in got] == [[(6, 33)], [], [(4, 26)], []]
    assert got[0].iban[0].score == got[2].iban[0].score + personal.CONTEXT_GAIN
    assert got[3].phone[0].score == personal.SCORES["phone"] + personal.CONTEXT_GAIN


def test_messy_and_empty(messy, nothing):
    assert personal.find(messy).count() == messy.count()
    assert personal.find(nothing).count() == 0
