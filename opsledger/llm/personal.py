"""Personal data: regular expressions propose spans, validators confirm them, nearby words adjust the score.

Kinds are email, ip, card (Luhn), phone and, beyond the base kinds, iban (mod 97). Positions are code points,
ends exclusive. A kind's matches are found leftmost and without overlap; failing ones are dropped and not tried
again from a later start. ``split`` gives the texts between the matches, so positions are running sums of lengths.
A context word of the kind within ``CONTEXT`` code points before a span raises its score by ``CONTEXT_GAIN`` points.

Defined cases: a null or empty text has no spans (counts 0, digest of the empty string); repeated rows give equal
rows; an empty table gives none; extra columns do not matter. All patterns are linear: possessive quantifiers and
"not in the middle of a run" starts give the same matches without retries inside long runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import table

CONTEXT = 40
CONTEXT_GAIN = 15
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban")

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
}
SCORES = {"email": 80, "ip": 55, "card": 80, "phone": 60, "iban": 85}
CONTEXT_WORDS = {
    "email": "mail|write to|contact|courriel|correo",
    "ip": "ip|host|server|address|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|anruf|mobil",
    "iban": "iban|account|bank|konto|compte|cuenta",
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Doubling every second digit from the right, the digit sum is divisible by ten."""
    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, -i, F.lit(1))) - F.lit(48)
        twice = digit * F.lit(2)
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(match: Column) -> Column:
    """The account number with its first four characters at the end, letters as 10 to 35, leaves 1 modulo 97."""
    text = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))
    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _octet(part: Column) -> Column:
    plain = F.regexp_replace(part, "^0+", "")
    return F.coalesce(F.when(plain == "", F.lit(0)).otherwise(plain.try_cast("int")), F.lit(999)) <= 255


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), _octet),
    "card": lambda m: F.length(_digits(m)).between(16, 19) & luhn(_digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
    "iban": mod97,
}


def spans(text: Column, kind: str) -> Column:
    """array<struct<kind, start, end, score>> of one kind; empty where there is none."""
    pattern = PATTERNS[kind]
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.expr("struct(0 AS at, CAST(array() AS array<struct<kind:string,start:int,end:int,match:string>>) AS found)")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["between"])
        end = start + F.length(pair["matches"])
        one = F.array(F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                               pair["matches"].alias("match")))
        return F.struct(end.alias("at"), F.concat(state["found"], one).alias("found"))

    pairs = F.arrays_zip(F.slice(between, F.lit(1), F.size(matches)).alias("between"), matches.alias("matches"))
    found = F.filter(F.aggregate(pairs, empty, step)["found"], lambda s: VALID[kind](s["match"]))

    def scored(span: Column) -> Column:
        begin = F.greatest(span["start"] - CONTEXT, F.lit(0))
        before = F.lower(F.substring(text, begin + 1, span["start"] - begin))
        gain = F.when(before.rlike(CONTEXT_WORDS[kind]), F.lit(CONTEXT_GAIN)).otherwise(F.lit(0))
        return F.struct(span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                        (F.lit(SCORES[kind]) + gain).alias("score"))

    none = F.expr("CAST(array() AS array<struct<kind:string,start:int,end:int,score:int>>)")
    return F.when(text.rlike(pattern), F.transform(found, scored)).otherwise(none)


def find(docs: DataFrame) -> DataFrame:
    """``doc_id`` and one span array per kind, named after the kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", *[spans(text, kind).alias(kind) for kind in KINDS])


def _joined(arrays: list[Column], last: str) -> Column:
    return F.array_join(F.transform(F.concat(*arrays), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s[last].cast("string"))), ",")


def op10_personal(spark, folder: str) -> DataFrame:
    found = find(table(spark, folder, "documents").select("doc_id", "text"))
    base, every = [F.col(k) for k in BASE_KINDS], [F.col(k) for k in KINDS]
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(base, "end").cast("binary"), 256).alias("base_sha256"),
        _joined(every, "end").alias("spans"), _joined(every, "score").alias("scores"),
    )


SQL_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SQL_DIGITS = "regexp_replace(s.m, '[^0-9]', '', 'g')"
SQL_VALID = {
    "email": "true",
    "ip": "list_bool_and(list_transform(string_split(s.m, '.'), lambda p: CAST(p AS HUGEINT) <= 255))",
    "card": f"""length({_SQL_DIGITS}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length({_SQL_DIGITS}) + 1),
        lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse({_SQL_DIGITS})[i] AS INT)
             ELSE (2 * CAST(reverse({_SQL_DIGITS})[i] AS INT)) // 10 + (2 * CAST(reverse({_SQL_DIGITS})[i] AS INT)) % 10 END)) % 10 = 0""",
    "phone": f"length({_SQL_DIGITS}) BETWEEN 8 AND 15",
}


def _sql() -> str:
    """The base kinds; account numbers need look-around, which this dialect lacks, so their count is taken as 0."""
    found = ",\n".join(f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{p}')) + 1), lambda i: {{
        'kind': '{k}', 'm': regexp_extract_all(t, '{p}')[i],
        'a': CAST(list_sum(list_transform(string_split_regex(t, '{p}')[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(regexp_extract_all(t, '{p}')[1:i - 1], lambda x: length(x))), 0) AS INT)}}),
        lambda s: {SQL_VALID[k]}) AS {k}""" for k, p in SQL_PATTERNS.items())
    def scored(k):
        return f"""list_transform({k}, lambda s: {{'kind': s.kind, 'a': s.a, 'b': s.a + length(s.m), 'score': {SCORES[k]} + CASE WHEN
        regexp_matches(lower(substr(t, greatest(s.a - {CONTEXT}, 0) + 1, s.a - greatest(s.a - {CONTEXT}, 0))), '{CONTEXT_WORDS[k]}')
        THEN {CONTEXT_GAIN} ELSE 0 END}})"""
    every = " || ".join(scored(k) for k in SQL_PATTERNS)
    def text(last):
        return f"array_to_string(list_transform(every, lambda s: s.kind || ':' || s.a || ':' || s.{last}), ',')"
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS (SELECT doc_id, t, {found} FROM texts),
    joined AS (SELECT *, {every} AS every FROM found)
    SELECT doc_id, {", ".join(f"CAST(len({k}) AS BIGINT) AS n_{k}" for k in SQL_PATTERNS)}, CAST(0 AS BIGINT) AS n_iban,
    sha256({text("b")}) AS base_sha256, {text("b")} AS spans, {text("score")} AS scores FROM joined"""


SQL = _sql()
