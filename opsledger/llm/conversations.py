"""Repair of conversation structure: the cheapest edits that make the roles read ``(system? (user assistant)+)?``.

Every turn is one of nine symbols: to be deleted (blank or seen before), or its role's initial, each also in a
truncated form that costs more to keep. Costs to the end of the conversation form a vector over the four states of
the pattern; less its smallest value there are few such vectors. Tables in the way of the Four Russians hold for every
vector and every block of ``BLOCK`` symbols the vector in front of the block and the cost that was taken off, so costs
run through a conversation from its end block by block, one lookup each. The trace then goes forward: a block is expanded
backward from the vector behind it, and in every state the first edit in ASCII order that keeps the cost is taken,
which yields the least of all cheapest audits because every later choice is already priced.

A conversation up to ``LONG_ROWS`` rows and ``LONG_BYTES`` bytes is read into one worker. A longer one is never held:
its rows get places in a stored range sort, repeated turns are found by an aggregate, one pass from the end
leaves the vector behind every row, and one pass from the start edits and hashes row by row in constant memory. One
digest of all its text is a sequential result, so these two passes of one conversation are each one task.

Defined cases: a null role or text is one space and so is a null conv_id or turn in the hash that chooses the damage;
rows of a null conv_id are one conversation; a null turn comes first; rows of one turn are ordered by the digest of
role and text; a role whose initial is not s, u or a (also an empty one) cannot be kept as it is; extra columns do not
matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opsledger.operators.indexing import ordered_positions

from .shared import broadcast_if_small, small_batches, store, table

BLOCK = 4
LONG_ROWS = 10_000
LONG_BYTES = 32 << 20
SPACES = " \t\n\x0b\x0c\r"

# The edits' costs.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States are 0 nothing yet, 1 after system, 2 after user, 3 after assistant; what may be added leads to:
ADDED = (2, 2, 3, 2)
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
ROLES = {2: "user", 3: "assistant"}
END = (0, 2 * INSERT, INSERT, 0)
MUST_GO = "x"
SYMBOLS = MUST_GO + "suao" + "SUAO"      # capitals are truncated, o is any other role

_OUT = ("conv_id {0}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired_sha256 string")


def _edits(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state after) of everything that may be done with one turn, in ASCII order."""
    yield "D", DELETE, state
    if symbol != MUST_GO:
        more = TRUNCATED if symbol.isupper() else 0
        if (symbol.lower(), state) in KEPT:
            yield "K", more, KEPT[symbol.lower(), state]
        yield "R", REROLE + more, ADDED[state]


def _before(symbol: str, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end in front of a turn, from those behind it."""
    costs = [min(cost + behind[to] for _, cost, to in _edits(symbol, state)) for state in range(4)]
    for _ in range(2):      # an inserted turn may be followed by another one
        costs = [min(c, INSERT + costs[ADDED[state]]) for state, c in enumerate(costs)]
    return tuple(costs)


class Tables:
    """All normalised cost vectors, and what one symbol and one block of symbols do to each."""

    def __init__(self):
        known, queue = {END: 0}, [END]
        one, cost = [], []
        for vector in queue:
            one.append([])
            cost.append([])
            for symbol in SYMBOLS:
                front = _before(symbol, vector)
                least = min(front)
                front = tuple(c - least for c in front)
                if front not in known:
                    known[front] = len(known)
                    queue.append(front)
                one[-1].append(known[front])
                cost[-1].append(least)
        self.vectors = queue
        self.one, self.one_cost = np.array(one), np.array(cost)
        self.block, self.block_cost = self.one, self.one_cost
        for _ in range(BLOCK - 1):      # one more symbol in front of the shorter blocks
            longer = self.one[self.block].transpose(0, 2, 1)
            longer_cost = (self.block_cost[:, :, None] + self.one_cost[self.block]).transpose(0, 2, 1)
            self.block, self.block_cost = longer.reshape(len(queue), -1), longer_cost.reshape(len(queue), -1)
        self.step = lru_cache(None)(self._step)
        self.expand = lru_cache(1 << 16)(self._expand)

    def _step(self, behind: int, symbol: int, state: int) -> tuple[str, int]:
        """Edits in front of and at a turn, and the state after it; of equal costs the first in ASCII order."""
        here, later = self.vectors[self.one[behind, symbol]], self.vectors[behind]
        taken, edits = int(self.one_cost[behind, symbol]), ""
        while True:
            options = [(edit, to) for edit, cost, to in _edits(SYMBOLS[symbol], state) if cost + later[to] == taken + here[state]]
            if INSERT + here[ADDED[state]] == here[state]:
                options.append(("I", -1))
            edit, to = min(options)
            edits += edit
            if edit != "I":
                return edits, to
            state = ADDED[state]

    def _expand(self, behind: int, block: int, state: int) -> tuple[tuple[str, ...], int]:
        """The edits of each turn of a block, from the vector behind it and the state in front of it."""
        turns = [block // len(SYMBOLS) ** k % len(SYMBOLS) for k in range(BLOCK - 1, -1, -1)]
        vectors = [behind]
        for symbol in reversed(turns):
            vectors.append(int(self.one[vectors[-1], symbol]))
        edits = []
        for symbol, vector in zip(turns, vectors[-2::-1], strict=True):
            done, state = self.step(vector, symbol, state)
            edits.append(done)
        return tuple(edits), state

    def repair(self, turns: list[int]) -> tuple[int, list[str]]:
        """Least cost, and per turn the edits in front of and at it; the last entry stands behind all turns."""
        whole = len(turns) // BLOCK * BLOCK
        vector, cost = 0, 0
        behind = [0] * (len(turns) - whole)
        for i in range(len(turns) - 1, whole - 1, -1):
            behind[i - whole] = vector
            cost += int(self.one_cost[vector, turns[i]])
            vector = int(self.one[vector, turns[i]])
        blocks = []
        for i in range(whole - BLOCK, -1, -BLOCK):
            number = 0
            for symbol in turns[i:i + BLOCK]:
                number = number * len(SYMBOLS) + symbol
            blocks.append((vector, number))
            cost += int(self.block_cost[vector, number])
            vector = int(self.block[vector, number])
        state, edits = 0, []
        for right, number in reversed(blocks):
            done, state = self.expand(right, number, state)
            edits += done
        for symbol, right in zip(turns[whole:], behind, strict=True):
            done, state = self.step(right, symbol, state)
            edits.append(done)
        return cost + self.vectors[vector][0], [*edits, closing(state)]


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def closing(state: int) -> str:
    """The turns to add at the end."""
    return "I" * (END[state] // INSERT)


def applied(edits: str, state: int, role: str, text: str) -> tuple[list[str], int]:
    """The lines that the edits in front of and at one turn leave, and the state after it."""
    out = []
    for edit in edits:
        if edit == "K":
            out.append(f"{role}:{text}")
            state = KEPT[role[0], state]
        elif edit != "D":
            state = ADDED[state]
            out.append(f"{ROLES[state]}:{text if edit == 'R' else ''}")
    return out, state


class Digest:
    """Lines joined by newlines, hashed as they come."""

    def __init__(self):
        self.hash, self.begun = hashlib.sha256(), False

    def add(self, lines: Iterable[str]) -> None:
        for line in lines:
            self.hash.update((b"\n" if self.begun else b"") + line.encode())
            self.begun = True


def symbol_of(fault: str, initial: str) -> str:
    if fault in ("blank", "duplicate"):
        return MUST_GO
    plain = initial if initial in ("s", "u", "a") else "o"
    return plain.upper() if fault == "truncated" else plain


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def described(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) without nulls in role and text, with ``fault`` (blank, truncated or none) and ``same``."""
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    shown = F.rtrim("text", F.lit(SPACES))
    ended = shown.endswith(".") | shown.endswith("!") | shown.endswith("?")
    return plain.withColumn("fault", F.when(shown == "", "blank").when(ended, "").otherwise("truncated")).withColumn(
        "same", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)))


def _repaired_short(rows: DataFrame, kind: str) -> DataFrame:
    """Conversations that fit into a worker, each finished where its rows meet."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out = tables(), []
        current, turns = None, []

        def finish() -> None:
            seen, faults = set(), []
            for _, _, _, fault, same in turns:
                faults.append(fault if fault == "blank" else "duplicate" if same in seen else fault)
                seen.add(same)
            initials = [role[:1] for _, role, _, _, _ in turns]
            cost, edits = known.repair([SYMBOLS.index(symbol_of(f, i)) for f, i in zip(faults, initials, strict=True)])
            digest, state = Digest(), 0
            for (_, role, text, _, _), edit in zip([*turns, (None, "", "", "", b"")], edits, strict=True):
                lines, state = applied(edit, state, role, text)
                digest.add(lines)
            numbers = {t for t, *_ in turns if t is not None}
            gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
            out.append((current[0], gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                        illegal(initials), cost, "".join(edits), digest.hash.hexdigest()))

        for batch in batches:
            lists = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv_id, *turn in zip(*lists, strict=True):
                if (conv_id,) != current:
                    if turns:
                        finish()
                    current, turns = (conv_id,), []
                turns.append(turn)
            yield _batch(out, batch.schema.field("conv_id").type)
            out.clear()
        if turns:
            finish()
            yield _batch(out, batch.schema.field("conv_id").type)

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "same")
    return dealt.select("conv_id", "turn", "role", "text", "fault", "same").mapInArrow(work, _OUT.format(kind))


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _repaired_long(rows: DataFrame, kind: str) -> DataFrame:
    """Conversations of any length: two passes over sorted rows in constant memory."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "same", F.monotonically_increasing_id()]
    placed = store(ordered_positions(rows, order, "at"), "conversations-placed")
    firsts = placed.groupBy("conv_id", "same").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    marked = placed.select("conv_id", "turn", "at", "fault", F.substring("role", 1, 1).alias("initial")) \
        .join(firsts, "at", "left").withColumn(
            "fault", F.when((F.col("fault") == "blank") | F.col("new"), F.col("fault")).otherwise("duplicate")).drop("new")
    marked = store(marked, "conversations-marked")
    sums = marked.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"),
        *[F.sum(F.when(F.col("fault") == f, 1).otherwise(0)).alias(f) for f in ("blank", "duplicate", "truncated")])

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per row the vector behind it, its symbol, the cost taken off at it, and whether it starts an illegal pair."""
        known = tables()
        current, vector, after = None, 0, ""
        for batch in batches:
            found = []
            for conv_id, at, fault, initial in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if (conv_id,) != current:
                    current, vector, after = (conv_id,), 0, None
                symbol = SYMBOLS.index(symbol_of(fault, initial))
                found.append((at, vector, symbol, int(known.one_cost[vector, symbol]),
                              int(after is not None and illegal([initial, after]))))
                vector, after = int(known.one[vector, symbol]), initial
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.int64()) for i in range(5)],
                                             ["at", "behind", "symbol", "taken", "illegal"])

    backward = marked.select("conv_id", "at", "fault", "initial").repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("at").desc())
    priced = store(backward.mapInArrow(price, "at long, behind long, symbol long, taken long, illegal long"), "conversations-priced")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out = tables(), []
        current = digest = None
        state = cost = bad = 0
        audit: list[str] = []

        def finish() -> None:
            last = closing(state)
            digest.add(applied(last, state, "", "")[0])
            out.append((current[0], 0, 0, 0, 0, bad, cost, "".join([*audit, last]), digest.hash.hexdigest()))

        for batch in batches:
            lists = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv_id, role, text, behind, symbol, taken, pair in zip(*lists, strict=True):
                if (conv_id,) != current:
                    if current is not None:
                        finish()
                    current, digest, state, bad, audit = (conv_id,), Digest(), 0, 0, []
                    # what is taken off at every row, and the rest at the start
                    cost = known.vectors[int(known.one[behind, symbol])][0]
                edits, _ = known.step(behind, symbol, state)
                lines, state = applied(edits, state, role, text)
                digest.add(lines)
                audit.append(edits)
                cost, bad = cost + taken, bad + pair
            yield _batch(out, batch.schema.field("conv_id").type)
            out.clear()
        if current is not None:
            finish()
            yield _batch(out, batch.schema.field("conv_id").type)

    forward = placed.join(priced, "at").repartition("conv_id").sortWithinPartitions("conv_id", "at")
    edited = forward.select("conv_id", "role", "text", "behind", "symbol", "taken", "illegal").mapInArrow(
        edit, _OUT.format(kind))
    return edited.drop("gaps", "blank", "duplicate", "truncated").withColumnRenamed("conv_id", "c").join(
        sums, F.col("c").eqNullSafe(F.col("conv_id"))).select(
        "conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired(rows: DataFrame, long_rows: int | None = None, long_bytes: int | None = None) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): its faults, the cheapest edits and the digest of what they leave."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    known = described(rows)
    weight = rows.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.sum(F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")).alias("bytes"))
    long = store(weight.where((F.col("n") > (long_rows or LONG_ROWS)) | (F.col("bytes") > (long_bytes or LONG_BYTES)))
                 .select(F.col("conv_id").alias("long_id")), "conversations-long")
    if long.isEmpty():
        return _repaired_short(known, kind)
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    few = broadcast_if_small(long)
    short = _repaired_short(known.join(few, is_long, "left_anti"), kind)
    return short.unionByName(_repaired_long(known.join(few, is_long, "left_semi"), kind))


def damaged(rows: DataFrame) -> DataFrame:
    """The test damage: by the hash of ``conv_id:turn`` a turn is dropped, emptied, unpunctuated, repeated or given to the user."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    role = F.when(fault == 4, "user").otherwise(shown("role"))
    copies = F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where(fault != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op11_conversations(spark, folder: str) -> DataFrame:
    small_batches(spark)
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = repaired(damaged(rows)).withColumnRenamed("conv_id", "c")
    every = rows.select("conv_id").distinct()
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


_CRC = r"""
steps AS (SELECT list(crc ORDER BY i) AS step FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc FROM range(256) r(i))),
hit AS (SELECT *, xor(list_reduce(list_prepend(4294967295, [(instr('0123456789ABCDEF', h[2 * k + 1]) - 1) * 16
        + instr('0123456789ABCDEF', h[2 * k + 2]) - 1 FOR k IN range(len(h) // 2)]),
    lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS f
  FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS h FROM conversations), steps)"""


def _sql() -> str:
    def best(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def edit(letter: str, cost: str, after: str, line: str = "", allowed: str = "true") -> str:
        lines = f"list_prepend({line}, {after}.r)" if line else f"{after}.r"
        return f"{{'c': CASE WHEN {allowed} THEN {after}.c + {cost} ELSE 1000000000 END, 'a': '{letter}' || {after}.a, 'r': {lines}}}"

    def turn(state: int) -> str:
        to = ADDED[state]
        out = [edit("D", "2", f"v{state}"), edit("R", "1 + more", f"v{to}", f"'{ROLES[to]}:' || text", "NOT gone")]
        out += [edit("K", "more", f"v{after}", "role || ':' || text", f"NOT gone AND initial = '{letter}'")
                for (letter, before), after in KEPT.items() if before == state]
        return best(*out)

    def closed(state: int, prefix: str) -> str:
        return best(f"{prefix}{state}", edit("I", "5", f"{prefix}{ADDED[state]}", f"'{ROLES[ADDED[state]]}:'"))

    return rf"""WITH RECURSIVE {_CRC},
rows_after AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) copies(copy)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS i,
    left(role, 1) AS initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending FROM rows_after),
judged AS (SELECT *, ending = '' AS blank, ending <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
    initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM placed),
marked AS (SELECT *, blank OR dup AS gone, NOT blank AND NOT dup AND ending NOT IN ('.', '!', '?') AS cut,
    CASE WHEN NOT blank AND NOT dup AND ending NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS more FROM judged),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE dup) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM marked GROUP BY conv_id),
priced(conv_id, i, v0, v1, v2, v3) AS (
  SELECT conv_id, n, {{'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])}}, {{'c': 10, 'a': 'II', 'r': ['user:', 'assistant:']}},
    {{'c': 5, 'a': 'I', 'r': ['assistant:']}}, {{'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])}} FROM sums
  UNION ALL
  SELECT conv_id, i, {closed(0, 'c')}, {closed(1, 'c')}, c2, c3 FROM (
    SELECT conv_id, i, b0 AS c0, b1 AS c1, {closed(2, 'b')} AS c2, {closed(3, 'b')} AS c3 FROM (
      SELECT p.conv_id, p.i - 1 AS i, {turn(0)} AS b0, {turn(1)} AS b1, {turn(2)} AS b2, {turn(3)} AS b3
      FROM priced p JOIN marked m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i))),
done AS (SELECT conv_id AS k, v0.c AS cost, v0.a AS audit, array_to_string(v0.r, chr(10)) AS lines FROM priced WHERE i = 0)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done ON k IS NOT DISTINCT FROM c.conv_id
"""


SQL = _sql()
