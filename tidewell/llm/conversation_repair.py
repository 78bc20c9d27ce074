"""Repair of damaged conversations by least edits (operator 11).

The rows of a conversation, by turn, must become a sequence of role initials that
matches (s?(ua)+)?.  A row is kept (0), given the role user or assistant (1) or deleted
(2; blank and repeated rows must be), an empty user or assistant row may be inserted
anywhere (5), and a truncated row that stays costs 5 more.  The edits wanted are the
cheapest, of those the ones whose initials in order are least.

`search` finds them for one block of rows by depth-first branch and bound: an explicit
stack, the least cost of the remaining rows from each state as bound, an incumbent of
(cost, audit), and a table of the best (cost, audit) that reached each row and state.
With this bound the first dive meets the optimum, and what is left only proves it, so
a block takes time in proportion to its rows whatever they are.

A conversation may be long: it is cut into blocks of 256 rows.  A block of a longer
conversation is searched from each of the four states to each (nothing yet, after system,
after user, after assistant), and 256 blocks, then 256 of those, are composed by cost and
by the order of the audits, until one is left; the chosen states then go down again.
No audit ends in an insertion inside a conversation, so of two different ones of equal cost
neither begins the other and their order is settled where they first differ.

Only digests of texts move until the edits are known; texts are joined to them once.  A
conversation's repaired text is hashed row by row as sorted rows stream by: SHA-256 cannot
be split, so the hash of one conversation is one task's work, in bounded memory.

Defined cases: a null role or text is one space, so a null text is blank; null turns come
first; rows of one turn are ordered by role and then by a digest of the text; equal rows
are counted before any shuffle and stand next to each other; null keys are one conversation;
a conversation without rows has zeros, an empty audit and the hash of the empty string; an
empty table gives an empty one.  A role counts by its first character.  Only the named
columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.llm.mixing import numbered
from tidewell.llm.tables import written

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5  # costs; to keep a row costs nothing
BLOCK_BITS = 8  # a block has 256 rows, and 256 blocks are composed at once
WHITE = " \t\n\x0b\x0c\r"
NEVER = 1 << 60

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
TO = (2, 2, 3, 2)  # after the next user or assistant
NAME = ("user", "user", "assistant", "user")  # which of them may come next
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: What is missing at the end of a conversation, by state: cost and insertions.
ENDS = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))


def _moves(state: int, role: str, fault: str) -> list[tuple[str, int, int]]:
    """(initial, cost, state after) of what may be done with a row; fault: '-' none,
    't' truncated, 'd' to be deleted."""
    out = [("D", DELETE, state)]
    if fault != "d":
        extra = TRUNCATED if fault == "t" else 0
        out.append(("R", REROLE + extra, TO[state]))
        if state in KEEP.get(role, ()):
            out.append(("K", extra, KEEP[role][state]))
    return out


@lru_cache(maxsize=1 << 16)
def search(roles: str, faults: str, start: int = 0, ends: tuple[tuple[int, str], ...] = ENDS) -> tuple[int, str]:
    """(cost, audit) of the best edits of rows from a state; `ends` gives what each final state adds."""
    n = len(roles)
    bound: list[list[int]] = [[]] * n + [[c for c, _ in ends]]
    for i in reversed(range(n)):
        row = [min(c + bound[i + 1][q] for _, c, q in _moves(state, roles[i], faults[i])) for state in range(4)]
        bound[i] = [min(row[q], INSERT + row[TO[q]], 2 * INSERT + row[TO[TO[q]]]) for q in range(4)]
    best: tuple[int, str] = (NEVER, "")
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        least = cost + bound[i][state]
        if least > best[0] or least == best[0] and audit > best[1][: len(audit)] or least >= NEVER:
            continue
        if (i, state) in reached and reached[i, state] <= (cost, audit):
            continue
        reached[i, state] = (cost, audit)
        if i == n:
            best = min(best, (cost + ends[state][0], audit + ends[state][1]))
            continue
        on = [(cost + c, letter, i + 1, q) for letter, c, q in _moves(state, roles[i], faults[i])]
        on.append((cost + INSERT, "I", i, TO[state]))
        # the most promising child is popped first
        for c, letter, j, q in sorted(on, key=lambda x: (-x[0] - bound[x[2]][x[3]], -ord(x[1]))):
            stack.append((j, q, c, audit + letter))
    return best


Matrix = tuple[list[int], list[int]]  # cost and rank of the audit, by 4 * state before + state after


def matrix(roles: str, faults: str) -> Matrix:
    """Best edits of a block between all states: costs, and the order of the audits from each state."""
    cost, rank = [], []
    for start in range(4):
        found = [search(roles, faults, start, tuple((0 if q == end else NEVER, "") for q in range(4))) for end in range(4)]
        order = sorted(audit for c, audit in found if c < NEVER)
        cost += [min(c, NEVER) for c, _ in found]
        rank += [order.index(audit) if c < NEVER else -1 for c, audit in found]
    return cost, rank


def _folded(parts: list[Matrix], start: int) -> tuple[list[int], list[int], list[list[int]]]:
    """Costs and ranks from one state through consecutive parts, and for each part the
    state before it on the best way to each state after it."""
    cost, rank = [0 if q == start else NEVER for q in range(4)], [0] * 4
    back = []
    for c, r in parts:
        ways = [min((cost[q] + c[4 * q + end], rank[q], q) for q in range(4)) for end in range(4)]
        back.append([q for _, _, q in ways])
        keys = [(rank[q], r[4 * q + end]) for end, (_, _, q) in enumerate(ways)]
        order = sorted(k for k, w in zip(keys, ways, strict=True) if w[0] < NEVER)
        cost = [min(w[0], NEVER) for w in ways]
        rank = [order.index(k) if w < NEVER else -1 for k, w in zip(keys, cost, strict=True)]
    return cost, rank, back


def compose(parts: list[Matrix]) -> Matrix:
    rows = [_folded(parts, start)[:2] for start in range(4)]
    return [c for cost, _ in rows for c in cost], [r for _, rank in rows for r in rank]


def trace(parts: list[Matrix], start: int, end: int) -> list[tuple[int, int]]:
    """The states before and after each part on the best way."""
    out = []
    for before in reversed(_folded(parts, start)[2]):
        out.append((before[end], end))
        end = before[end]
    return out[::-1]


def ending(whole: Matrix) -> int:
    """Final state of the best way from the start, with what is added at the end."""
    return min((whole[0][q] + ENDS[q][0], whole[1][q], q) for q in range(4))[2]


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults by crc32 of `conv:turn`: (c, t, role, text, n), n copies each; of
    a dropped row only its conversation is left, with n = 0."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(some(conv), F.lit(":"), some(turn))) % 20
    gone = kind == 0
    words = F.when(kind == 1, "").when(kind == 2, F.translate(some(text), ".!?", "")).otherwise(some(text))
    return rows.select(F.col(conv).alias("c"), F.when(~gone, F.col(turn)).alias("t"), F.when(gone, "").when(kind == 4, "user").otherwise(some(role)).alias("role"),
                       F.when(gone, "").otherwise(words).alias("text"), F.when(gone, 0).when(kind == 3, 2).otherwise(1).alias("n"))


def whole(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as they are, for `repair`."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv).alias("c"), F.col(turn).alias("t"), some(role).alias("role"), some(text).alias("text"), F.lit(1).alias("n"))


def _faults(rows: DataFrame) -> DataFrame:
    """One row for equal rows, in order: number `at`, copies, first fault, without the text."""
    body = F.rtrim("text", F.lit(WHITE))
    light = rows.select("c", "t", "role", F.unhex(F.sha2("text", 256)).alias("digest"), (F.length(body) == 0).alias("blank"),
                        (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"), "n")
    light = light.groupBy("c", "t", "role", "digest").agg(F.first("blank").alias("blank"), F.first("cut").alias("cut"), F.sum("n").alias("n"))
    ordered = numbered(light, [F.asc_nulls_first("c"), F.asc_nulls_first("t"), F.col("role"), F.col("digest")], "at")
    again = (ordered.filter((F.col("n") > 0) & ~F.col("blank")).groupBy("c", "role", "digest").agg(F.min("at").alias("first"), F.count("*").alias("times"))
             .filter("times > 1").drop("times"))
    o, a = ordered.alias("o"), again.alias("a")
    met = o.join(a, F.col("o.c").eqNullSafe(F.col("a.c")) & (F.col("o.role") == F.col("a.role")) & (F.col("o.digest") == F.col("a.digest")), "left")
    first = ordered.groupBy("c").agg(F.min("at").alias("g"), F.max("at").alias("z")).alias("f")
    met = met.select("o.*", (F.col("first") < F.col("at")).alias("again")).alias("m")
    out = met.join(first, F.col("m.c").eqNullSafe(F.col("f.c"))).select("m.*", "g", F.shiftright(F.col("z") - F.col("g"), BLOCK_BITS).alias("last"))
    fault = F.when(F.col("blank") | F.coalesce("again", F.lit(False)), "d").when(F.col("cut"), "t").otherwise("-")
    initial = F.left("role", F.lit(1))
    return out.select("c", "g", "at", "last", F.shiftright(F.col("at") - F.col("g"), BLOCK_BITS).alias("b"), "t", "role", "digest", "n", "blank", fault.alias("fault"),
                      F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"))


def repair(rows: DataFrame, conv: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Of rows (c, t, role, text, n): one row a conversation, and the repaired lines
    (g, at, k, line) in the order of (g, at, k), g being the conversation's number."""
    marked = written(_faults(rows), "repair-marked")
    there = F.col("n") > 0
    turn, more = F.when(there, F.col("t")), F.col("n") - 1
    count = lambda c: F.coalesce(F.sum(F.when(there, c)), F.lit(0)).cast("long")
    facts = marked.groupBy("g").agg(
        F.first("c").alias("c"), F.coalesce(F.max(turn) - F.min(turn) + 1 - F.countDistinct(turn), F.lit(0)).cast("long").alias("gaps"),
        count(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        count(F.when(F.col("blank"), 0).when(F.col("fault") == "d", F.col("n")).otherwise(more)).alias("duplicate"),
        count((F.col("fault") == "t").cast("int")).alias("truncated"))

    kept = marked.filter(there)
    row = F.struct("at", "initial", "fault", "n", "t", "role", "digest")
    blocks = kept.groupBy("g", "b", "last").agg(F.sort_array(F.collect_list(row)).alias("rows"))  # at most 256 rows
    text = lambda f: F.array_join(F.transform("rows", f), "")
    blocks = written(blocks.select("g", "b", "last", "rows", text(lambda x: x["initial"]).alias("roles"), text(lambda x: x["fault"]).alias("faults")), "repair-blocks")
    # adjacent pairs that are not su, ua or au: inside blocks, among copies, and from block to block
    inside = F.length("roles") - 1 - F.regexp_count("roles", F.lit("(?=su|ua|au)")) + F.aggregate("rows", F.lit(0).cast("long"), lambda s, x: s + x["n"] - 1)
    ends = blocks.filter("last > 0").select("g", "b", F.left("roles", F.lit(1)).alias("head"), F.right("roles", F.lit(1)).alias("tail"))
    met = ends.select("g", "b", "head").join(ends.select("g", (F.col("b") + 1).alias("b"), "tail"), ["g", "b"])
    between = met.select("g", (~F.concat("tail", "head").isin("su", "ua", "au")).cast("long").alias("illegal"))
    illegal = blocks.select("g", inside.cast("long").alias("illegal")).unionByName(between).groupBy("g").agg(F.sum("illegal").alias("illegal"))

    states = _states(blocks)
    chosen = blocks.join(states, ["g", "b"], "left") if states is not None else blocks.withColumns({"start": F.lit(None).cast("int"), "end": F.lit(None).cast("int")})
    kinds = "g long, b long, rows array<struct<at long, initial string, fault string, n long, t {t}, role string, digest binary>>, cost long, audit string, before array<string>, role array<string>, after string"
    edits = written(chosen.select("g", "b", "last", "rows", F.col("rows.n").alias("copies"), "roles", "faults", "start", "end")
                    .mapInArrow(_edits, kinds.format(t=rows.schema["t"].dataType.simpleString())), "repair-edits")
    lines = written(_lines(rows, marked.select("g", "at", "c"), edits), "repair-lines")
    hashes = lines.repartition("g").sortWithinPartitions("g", "at", "k").select("g", "line").mapInArrow(_hashes, "g long, repaired_sha256 string")
    audits = edits.select("g", "b", "audit").repartition("g").sortWithinPartitions("g", "b").select("g", "audit").mapInArrow(_joined, "g long, audit string")
    costs = edits.groupBy("g").agg(F.sum("cost").alias("cost"))
    out = facts.join(illegal, "g", "left").join(costs, "g", "left").join(audits, "g", "left").join(hashes, "g", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    table = out.select(F.col("c").alias(conv), "gaps", "blank", "duplicate", "truncated", zero("illegal"), zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
    return table, lines


def _states(blocks: DataFrame) -> DataFrame | None:
    """(g, b, start, end) for blocks of conversations that have more than one."""
    long = blocks.filter("last > 0")
    top = long.agg(F.max("b")).first()[0]
    if top is None:
        return None
    shape = "g long, b long, cost array<long>, rank array<int>"
    levels = [written(long.select("g", "b", "roles", "faults").mapInArrow(_matrices, shape), "repair-level")]
    parts = lambda level: level.groupBy("g", F.shiftright("b", BLOCK_BITS).alias("b")).agg(F.sort_array(F.collect_list(F.struct("b", "cost", "rank"))).alias("parts"))
    while top > 0:
        levels.append(written(parts(levels[-1]).select("g", "b", "parts").mapInArrow(_composed, shape), "repair-level"))
        top >>= BLOCK_BITS
    way = "g long, b long, start int, end int"
    chosen = levels.pop().mapInArrow(_endings, way)
    while levels:
        chosen = written(parts(levels.pop()).join(chosen, ["g", "b"]).select("g", "parts", "start", "end").mapInArrow(_traced, way), "repair-states")
    return chosen


def _batch(rows: list, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=names)


def _matrix_rows(rows: list) -> pa.RecordBatch:
    return _batch(rows, ["g", "b", "cost", "rank"], [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())])


def _state_rows(rows: list) -> pa.RecordBatch:
    return _batch(rows, ["g", "b", "start", "end"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _matrix_rows([(r["g"], r["b"], *matrix(r["roles"], r["faults"])) for r in b.to_pylist()])


def _parts(row: dict) -> list[Matrix]:
    return [(p["cost"], p["rank"]) for p in row["parts"]]


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _matrix_rows([(r["g"], r["b"], *compose(_parts(r))) for r in b.to_pylist()])


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _state_rows([(r["g"], r["b"], 0, ending((r["cost"], r["rank"]))) for r in b.to_pylist()])


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _state_rows([(r["g"], p["b"], *way) for r in b.to_pylist() for p, way in zip(r["parts"], trace(_parts(r), r["start"], r["end"]), strict=True)])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost, audit and what happens to each row: lines before it, and its role (null: deleted, empty: as it is)."""
    for b in batches:
        out = []
        for last, number, copies, roles, faults, start, end in zip(*(b.column(c).to_pylist() for c in ("last", "b", "copies", "roles", "faults", "start", "end")), strict=True):
            if start is None:
                state, (cost, audit) = 0, search(roles, faults)
            else:  # a block of a longer conversation
                state = start
                cost, audit = search(roles, faults, start, tuple((0 if q == end else NEVER, "") for q in range(4)))
                if number == last:
                    cost, audit = cost + ENDS[end][0], audit + ENDS[end][1]
            shown, before, role, lines, i = [], [], [], [], 0
            for letter in audit:
                if letter == "I":
                    lines.append(f"{NAME[state]}:")
                    state = TO[state]
                    shown.append("I")
                    continue
                before.append("\n".join(lines))
                lines = []
                role.append(None if letter == "D" else "" if letter == "K" else NAME[state])
                state = state if letter == "D" else KEEP[roles[i]][state] if letter == "K" else TO[state]
                shown.append(letter + "D" * (copies[i] - 1))
                i += 1
            out.append((cost + DELETE * (sum(copies) - len(copies)), "".join(shown), before, role, "\n".join(lines)))
        new = _batch(out, ["cost", "audit", "before", "role", "after"], [pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()])
        yield pa.RecordBatch.from_arrays([b.column("g"), b.column("b"), b.column("rows"), *new.columns], names=["g", "b", "rows", *new.schema.names])


def _lines(rows: DataFrame, keys: DataFrame, edits: DataFrame) -> DataFrame:
    """Repaired lines: inserted ones from the edits, kept ones with their texts."""
    each = edits.select("g", F.explode(F.arrays_zip("rows", "before", F.col("role").alias("as"))).alias("e"))
    each = each.select("g", F.col("e.rows.at").alias("at"), F.col("e.rows.t").alias("t"), F.col("e.rows.role").alias("role"), F.col("e.rows.digest").alias("digest"), F.col("e.before").alias("before"), F.col("e.as").alias("as"))
    inserted = each.filter("before <> ''").select("g", "at", F.lit(-1).alias("k"), F.col("before").alias("line"))
    added = edits.filter("after <> ''").select("g", F.element_at("rows", -1)["at"].alias("at"), F.lit(1).alias("k"), F.col("after").alias("line"))
    stay = each.filter(F.col("as").isNotNull()).join(keys, ["g", "at"]).alias("s")
    texts = (rows.filter("n > 0").withColumn("digest", F.unhex(F.sha2("text", 256))).groupBy("c", "t", "role", "digest").agg(F.first("text").alias("text"))).alias("x")
    on: Column = F.col("s.digest") == F.col("x.digest")
    for name in ("c", "t", "role"):
        on = on & F.col(f"s.{name}").eqNullSafe(F.col(f"x.{name}"))
    role = F.when(F.col("as") == "", F.col("s.role")).otherwise(F.col("as"))
    kept = stay.join(texts, on).select("g", "at", F.lit(0).alias("k"), F.concat(role, F.lit(":"), F.col("text")).alias("line"))
    return kept.unionByName(inserted).unionByName(added)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the newline-joined lines of each run of equal g."""
    g, digest, out = None, None, []
    for b in batches:
        for key, line in zip(b.column("g").to_pylist(), b.column("line").cast(pa.binary()), strict=True):
            if key != g:
                if digest:
                    out.append((g, digest.hexdigest()))
                g, digest = key, hashlib.sha256(line.as_py())
            else:
                digest.update(b"\n")
                digest.update(line.as_py())
        yield _batch(out, ["g", "repaired_sha256"], [pa.int64(), pa.string()])
        out = []
    yield _batch([(g, digest.hexdigest())] if digest else [], ["g", "repaired_sha256"], [pa.int64(), pa.string()])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits of the blocks of each run of equal g, one after the other."""
    g, parts, out = None, [], []
    for b in batches:
        for key, audit in zip(b.column("g").to_pylist(), b.column("audit").to_pylist(), strict=True):
            if key != g and parts:
                out.append((g, "".join(parts)))
                parts = []
            g = key
            parts.append(audit)
        yield _batch(out, ["g", "audit"], [pa.int64(), pa.string()])
        out = []
    yield _batch([(g, "".join(parts))] if parts else [], ["g", "audit"], [pa.int64(), pa.string()])


def damaged_report(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damage, repair, and one row a conversation."""
    return repair(damage(rows, conv, turn, role, text), conv)[0]
