import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from opsledger.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def cheapest(turns):
    """(cost, audit, lines) by trying everything from each place on, keeping the least (cost, audit); turns: (role, text, gone, cut)."""
    to_user = {"": "u", "s": "su", "u": "ua", "a": "au"}
    known = {}

    def go(i, last, left):
        """The pattern so far ends in ``last``; at most ``left`` more insertions here."""
        if (i, last, left) in known:
            return known[i, last, left]
        options = []
        if i == len(turns) and last in ("", "a"):
            options.append((0, "", ()))
        after = to_user[last][-1]
        name = {"u": "user", "a": "assistant"}[after]
        if left:
            c, a, r = go(i, after, left - 1)
            options.append((c + 5, "I" + a, (f"{name}:", *r)))
        if i < len(turns):
            role, text, gone, cut = turns[i]
            c, a, r = go(i + 1, last, 3)
            options.append((c + 2, "D" + a, r))
            if not gone:
                c, a, r = go(i + 1, after, 3)
                options.append((c + 1 + 5 * cut, "R" + a, (f"{name}:{text}", *r)))
                if role[:1] == after or (role[:1] == "s" and last == ""):
                    c, a, r = go(i + 1, role[0], 3)
                    options.append((c + 5 * cut, "K" + a, (f"{role}:{text}", *r)))
        known[i, last, left] = min(options, default=(10 ** 9, "", ()))
        return known[i, last, left]

    for i in range(len(turns), -1, -1):     # keeps the recursion shallow
        for left, last in itertools.product(range(4), ("a", "u", "s", "")):
            go(i, last, left)
    return go(0, "", 3)


def brute(rows):
    out = {}
    for conv_id in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == conv_id]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
        seen, turns, faults = set(), [], []
        for _, role, text in mine:
            body = text.rstrip(BLANK)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            turns.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = {r[0] for r in mine if r[0] is not None}
        cost, audit, lines = cheapest(turns)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:], strict=False)]
        out[conv_id] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
                        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, conversations=150, longest=14):
    r, rows = random.Random(seed), []
    roles = ["user", "assistant", "system", "tool", "", "ünder", "user", "assistant"]
    texts = ["Yes.", "Hm", "", " \t", "What? ", "Why!\n", "cut off", "é 字", "ok.", "Sure"]
    for c in range(conversations):
        for t in range(r.randrange(1, longest)):
            role = r.choice(roles) if r.random() < 0.4 else ["user", "assistant"][t % 2]
            rows.append((c, r.choice([t, t, t, t + 3, None]), role, r.choice(texts) if r.random() < 0.5 else f"text {c} {t}."))
    return rows


def collected(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def test_every_short_conversation_equals_trying_all_edits():
    kinds = [("system", "s.", False, False), ("user", "u.", False, False), ("assistant", "a.", False, False), ("tool", "t.", False, False),
             ("user", "x", True, False), ("user", "c", False, True), ("assistant", "c", False, True), ("system", "c", False, True), ("t", "c", False, True)]
    names = {0: "s", 1: "u", 2: "a", 3: "o", 4: "x", 5: "U", 6: "A", 7: "S", 8: "O"}
    r = random.Random(1)
    chosen = [c for n in range(4) for c in itertools.product(range(9), repeat=n)]
    chosen += [tuple(r.choices(range(9), k=r.randrange(4, 30))) for _ in range(600)]
    for turns in chosen:
        cost, audit, lines = cheapest([kinds[k] for k in turns])
        got_cost, edits = cv.tables().repair([cv.SYMBOLS.index(names[k]) for k in turns])
        assert (got_cost, "".join(edits)) == (cost, audit), turns
        made, state = [], 0
        for k, edit in zip([*turns, None], edits, strict=True):
            some, state = cv.applied(edit, state, *(kinds[k][:2] if k is not None else ("", "")))
            made += some
        assert tuple(made) == lines
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in made))


def test_block_tables_equal_single_steps():
    known, r = cv.Tables(), random.Random(2)
    for _ in range(3000):
        vector, turns = r.randrange(len(known.vectors)), [r.randrange(9) for _ in range(cv.BLOCK)]
        number, at, cost = 0, vector, 0
        for s in turns:
            number = number * 9 + s
        for s in reversed(turns):
            cost += known.one_cost[at, s]
            at = known.one[at, s]
        assert known.block[vector, number] == at and known.block_cost[vector, number] == cost


@pytest.mark.parametrize("limits", [{}, {"long_rows": 0}, {"long_rows": 6}, {"long_bytes": 30}])
def test_equals_brute_force(spark, limits):
    rows = [(c, t, r, x) for c, t, r, x in random_rows(3) if r is not None]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert collected(cv.repaired(frame, **limits)) == brute(rows)


def test_one_very_long_conversation(spark):
    rows = [(1, t, ["user", "assistant"][(t + t // 7) % 2], f"text {t % 900}" + "." * (t % 3 > 0)) for t in range(3000)] + random_rows(4, 5)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    want = brute(rows)
    assert collected(cv.repaired(frame)) == want
    assert collected(cv.repaired(frame, long_rows=100)) == want


def test_messy_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (None, 1, "user", "No id."), (None, None, None, None),
            (2, 5, "system", "x" * 300_000 + "."), (2, 6, "user", "Q?"), (2, 9, "assistant", "A"), (3, 1, "assistant", ""), (4, None, "user", "a.")]
    frame = spark.createDataFrame([(*r, "k", 1, "s") for r in rows], SCHEMA + ", fault string, at long, same string")
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for limits in ({}, {"long_rows": 0}):
        assert collected(cv.repaired(frame, **limits)) == brute(plain)
        assert cv.repaired(frame.limit(0), **limits).count() == 0


def test_damage_and_conversations_without_rows(spark, tmp_path):
    rows = random_rows(5, 300, 4)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = collected(cv.op11_conversations(spark, str(tmp_path)))
    want = brute(damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    lost = {r[0] for r in rows} - want.keys()
    assert lost and got == want | dict.fromkeys(lost, empty)
    frame = spark.read.parquet(str(tmp_path / "conversations.parquet"))
    assert sorted(map(tuple, cv.damaged(frame).collect()), key=repr) == sorted(damage(rows), key=repr)
    assert cv.damaged(frame.where(F.lit(False))).count() == 0
