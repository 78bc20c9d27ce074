import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tidewell.llm import conversation_repair as cr

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"
COST = {"K": 0, "R": 1, "D": 2, "I": 5}


def exhaustive(roles, faults, gap=2):
    """Best (cost, audit) among all edits with at most `gap` insertions in a place."""
    best = None
    for letters in itertools.product("KRD", repeat=len(roles)):
        if any(f == "d" and x != "D" for f, x in zip(faults, letters)):
            continue
        for gaps in itertools.product(range(gap + 1), repeat=len(roles) + 1):
            audit, may = "", []
            for i in range(len(roles) + 1):
                audit += "I" * gaps[i]
                may += ["ua"] * gaps[i]
                if i < len(roles):
                    audit += letters[i]
                    may += {"K": [roles[i]], "R": ["ua"], "D": []}[letters[i]]
            cost = sum(COST[x] for x in audit) + 5 * sum(f == "t" and x != "D" for f, x in zip(faults, letters))
            if best and best <= (cost, audit):
                continue
            if any(GRAMMAR.fullmatch("".join(w)) for w in itertools.product(*may)):
                best = (cost, audit)
    return best


def test_search_finds_the_best_of_all_edits():
    for n in (0, 1, 2):
        for roles in itertools.product("suax", repeat=n):
            for faults in itertools.product("-td", repeat=n):
                assert cr.search("".join(roles), "".join(faults)) == exhaustive(roles, faults)
    rng = random.Random(1)
    for _ in range(25):
        roles, faults = "".join(rng.choices("suax", k=3)), "".join(rng.choices("--td", k=3))
        assert cr.search(roles, faults) == exhaustive(roles, faults)


def table(roles, faults):
    """Best (cost, audit) by a table over rows and states, with the role each letter gives."""
    to, keep = cr.TO, cr.KEEP
    inf = (10 ** 9, "")

    def filled(row):
        for _ in range(2):
            for q in range(4):
                if row[q] != inf:
                    row[to[q]] = min(row[to[q]], (row[q][0] + 5, row[q][1] + "I"))
        return row
    row = filled([(0, "")] + [inf] * 3)
    for r, f in zip(roles, faults):
        new = [inf] * 4
        for q in range(4):
            if row[q] == inf:
                continue
            c, a = row[q]
            new[q] = min(new[q], (c + 2, a + "D"))
            if f != "d":
                x = 5 if f == "t" else 0
                new[to[q]] = min(new[to[q]], (c + 1 + x, a + "R"))
                if q in keep.get(r, ()):
                    new[keep[r][q]] = min(new[keep[r][q]], (c + x, a + "K"))
        row = filled(new)
    return min(row[0], row[3])


def test_search_of_long_rows_is_the_table(spark):
    rng = random.Random(2)
    for weights in ((1, 5, 5, 1), (9, 1, 1, 0), (0, 9, 1, 0)):
        for n in (5, 40, 256):
            roles, faults = "".join(rng.choices("suax", weights, k=n)), "".join(rng.choices("-td", (6, 2, 1), k=n))
            assert cr.search(roles, faults) == table(roles, faults)
    for roles in ("s" * 256, "u" * 256, "a" * 256, "x" * 256):
        for f in "-td":
            assert cr.search(roles, f * 256) == table(roles, f * 256)


def test_composed_blocks_are_one_search():
    rng = random.Random(3)
    for _ in range(40):
        n = rng.randrange(2, 60)
        roles, faults = "".join(rng.choices("suax", (1, 5, 5, 1), k=n)), "".join(rng.choices("-td", (6, 2, 1), k=n))
        cuts = sorted({0, n, *(rng.randrange(n) for _ in range(6))})
        parts = [cr.matrix(roles[a:b], faults[a:b]) for a, b in itertools.pairwise(cuts)]
        tree = cr.compose([cr.compose(parts[:2]), *parts[2:]])
        end = cr.ending(tree)
        assert tree[0][end] + cr.ENDS[end][0] == cr.search(roles, faults)[0]
        way = cr.trace(parts, 0, end)
        audit = "".join(cr.search(roles[a:b], faults[a:b], s, tuple((0 if q == e else cr.NEVER, "") for q in range(4)))[1]
                        for (a, b), (s, e) in zip(itertools.pairwise(cuts), way, strict=True))
        assert audit + cr.ENDS[end][1] == cr.search(roles, faults)[1]


def plain(rows):
    """The report of [(conv, turn, role, text)], row by row."""
    some = lambda v: " " if v is None else str(v)
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c]
        k = zlib.crc32(f"{some(c)}:{some(t)}".encode()) % 20
        r, x = some(r), some(x)
        if k == 0:
            continue
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        convs[c] += [(t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    out = Counter()
    for c, kept in convs.items():
        kept.sort(key=lambda e: (e[0] is not None, e[0] or 0, e[1], hashlib.sha256(e[2].encode()).digest()))
        turns = [t for t, _, _ in kept if t is not None]
        seen, faults = set(), ""
        n = Counter()
        for _, r, x in kept:
            body = re.findall(r"[^\x20\x09-\x0D]", x)
            f = "blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((r, x))
            n[f] += 1
            faults += "d" if f in ("blank", "duplicate") else "t" if f else "-"
        heads = [r[:1] for _, r, _ in kept]
        cost, audit = table(heads, faults)
        lines, state, i = [], 0, 0
        for letter in audit:
            if letter == "I":
                lines.append(cr.NAME[state] + ":")
                state = cr.TO[state]
                continue
            _, r, x = kept[i]
            if letter == "K":
                state = cr.KEEP[r[:1]][state]
                lines.append(f"{r}:{x}")
            elif letter == "R":
                lines.append(f"{cr.NAME[state]}:{x}")
                state = cr.TO[state]
            i += 1
        out[(c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
             sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(heads)), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())] += 1
    return out


def report(spark, rows, parts=3):
    d = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return Counter(tuple(r) for r in cr.damaged_report(d).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect())


def talk(rng, c, n):
    texts = ["Yes.", "No", "é!\n", " ", "Why? ", None, "\x1c", "go on...", "日本。"]
    role = lambda t: rng.choice([("user", "assistant")[t % 2]] * 8 + ["system", "tool", "", None, "use", "ärger"])
    return [(c, rng.choice([t] * 9 + [t + 1, None]), role(t), rng.choice(texts) if rng.random() < 0.4 else f"w{rng.random()}.") for t in range(n)]


def test_reports_are_those_of_plain_code(spark):
    rng = random.Random(4)
    rows = [r for c in range(150) for r in talk(rng, c, rng.randrange(1, 9))]
    rows += talk(rng, None, 12) + talk(rng, 777, 700)
    assert report(spark, rows) == plain(rows)


def test_long_conversations_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK_BITS", 1)
    rng = random.Random(5)
    rows = [r for c in range(12) for r in talk(rng, c, rng.randrange(1, 40))] + [(99, i // 50, "user", f"{i % 7}.") for i in range(150)]
    assert report(spark, rows) == plain(rows)


@pytest.mark.parametrize("copies", [3, 400])
def test_copies(spark, copies):
    rows = [(1, 2, "user", "a.")] * copies + [(1, 3, "assistant", "b")] * copies + [(1, None, None, None)] * copies + [(2, 1, "user", "")]
    assert report(spark, rows) == plain(rows)


def test_all_rows_dropped_empty_and_long(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    rows = [(gone, 1, "user", "a."), (-1, 0, "user", "word " * 50_000 + "."), (-1, 1, "assistant", "x" * 300_000)]
    assert report(spark, rows) == plain(rows)
    assert report(spark, []) == Counter()
    extra = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", g int, role2 string")
    assert cr.damaged_report(extra.withColumnRenamed("role2", "n")).count() == 2


def test_undamaged_conversations_stay_as_they_are(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    table_, lines = cr.repair(cr.whole(spark.createDataFrame(rows, SCHEMA)))
    assert {(r.conv_id, r.cost, r.audit) for r in table_.collect()} == {(1, 0, "KKK"), (2, 0, "KK")}
    assert [r.line for r in lines.orderBy("g", "at", "k").collect()] == [f"{r}:{x}" for _, _, r, x in rows]
