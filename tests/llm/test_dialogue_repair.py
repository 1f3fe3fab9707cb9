"""Conversation repair against a shortest-path search over all edits, and its handling of odd rows."""

import hashlib
import heapq
import random
import re
import zlib

from conftest import SMALL

from folioworks.llm import dialogue_repair as repair
from folioworks.llm.queries import QUERIES

ROWS = "conv_id bigint, turn bigint, role string, text string, conv string, sym int, none boolean, n int"


def cheapest(rows):
    """Least cost and ASCII-least audit; ``rows`` holds (initial, fault), fault 0 sound, 1 truncated, 2 must go."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    legal = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    heap, seen = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, last = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        if (i, last) in seen:
            continue
        seen.add((i, last))
        heapq.heappush(heap, (cost + 2, audit + "I", i, follow[last]))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
            if fault < 2:
                heapq.heappush(heap, (cost + 2 + fault, audit + "R", i + 1, follow[last]))
                if (last, initial) in legal:
                    heapq.heappush(heap, (cost + fault, audit + "K", i + 1, initial))


def expected(table):
    """The contract, word by word, over a list of (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in (r for r in table if r[0] == conv):
            key = ":".join(" " if v is None else str(v) for v in (c, turn))
            kind = zlib.crc32(key.encode()) % 20
            role, text = (" " if v is None else v for v in (role, text))
            if kind == 1:
                text = ""
            elif kind == 2:
                text = re.sub("[.!?]", "", text)
            elif kind == 4:
                role = "user"
            rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen = [], set()
        for _, role, text in rows:
            words = re.findall("[^\x20\x09-\x0d]", text)
            faults.append(2 if not words else 3 if (role, text) in seen else 1 if words[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest([(i, min(f, 2)) for i, f in zip(initials, faults)])
        new, last, left = [], "", list(rows)
        for edit in audit:
            given = "assistant" if last == "u" else "user"
            _, role, text = (None, given, "") if edit == "I" else left.pop(0)
            if edit != "D":
                role = role if edit == "K" else given
                new.append(f"{role}:{text}")
                last = role[:1]
        assert re.fullmatch("(s?(ua)+)?", "".join(line[:1] for line in new))
        digest = hashlib.sha256("\n".join(new).encode()).hexdigest()
        out[conv] = (gaps, faults.count(2), faults.count(3), faults.count(1), illegal, cost, audit, digest)
    return out


def found(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def test_runs_against_shortest_paths():
    random.seed(5)
    for _ in range(3000):
        rows = []
        for _ in range(random.randint(0, 5)):
            rows += [(random.choice(["s", "u", "a", "x", ""]), random.choice([0, 0, 1, 2]))] * random.choice([1, 1, 2, 3, 40])
        runs = repair.joined([[(repair.symbol(i, f), 1)] for i, f in rows])
        assert repair.unpack(repair.pack(runs)) == runs
        assert repair.repair(runs) == cheapest(rows)


def test_powers_cross_a_run_as_single_steps_do():
    for sym in range(16):
        rest = step = (0, 7, 2, 5)
        for length in range(1, 70):
            step = repair._over(sym, step)
            assert repair.crossed(sym, length, rest) == step


def test_query_against_the_contract(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op11_dialogue_repair"](spark, SMALL)
    assert found(df) == expected(rows)
    assert dict(df.dtypes)["cost"] == "bigint" and dict(df.dtypes)["audit"] == "string"


def test_random_and_odd_rows(spark):
    random.seed(9)
    roles = ["system", "user", "assistant", "admin", "", None, "User"]
    texts = ["Yes.", "no", "", " \n", None, "Why?", " ", "ok! \t", "long " * 20_000 + ".", "x.　"]
    table = [
        (random.choice([None, -4, *range(40)]), random.choice([None, -1, *range(12)]), random.choice(roles[:3] * 4 + roles), random.choice(texts))
        for _ in range(700)
    ]
    # Rows of one turn and role are ordered by a hash, so the plain version gets no two such texts; whole repeats are left in.
    first = {}
    table = [r for r in table if first.setdefault((r[0], r[1], "user" if r[2] is None else r[2]), r) == r]
    crc = {(c, t): zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 for c, t, *_ in table}
    table = [r for r in table if crc[r[0], r[1]] != 4]
    extra = [(*r, "c", 3, True, 5) for r in table]
    assert found(repair.repair_conversations(spark.createDataFrame(extra, ROWS))) == expected(table)


def test_conversation_that_spans_many_ranges(spark):
    table = [(1, t, "user" if t % 3 else "assistant", f"text {t % 50}." if t % 7 else "") for t in range(4000)] + [(2, 0, "system", "Hi.")]
    df = spark.createDataFrame([(*r, "c", 3, True, 5) for r in table], ROWS).repartition(7)
    assert found(repair.repair_conversations(df)) == expected(table)


def test_without_rows_and_without_damage(spark):
    none = spark.createDataFrame([], ROWS)
    assert repair.repair_conversations(none).collect() == []
    lost = next(t for t in range(99) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(5, lost, "user", "Gone.", "c", 3, True, 5)], ROWS)
    assert found(repair.repair_conversations(one)) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    kept = found(repair.repair_conversations(one, damage=False))[5]
    assert kept[5:7] == (2, "KI")
    strings = one.withColumn("conv_id", one.conv_id.cast("string"))
    assert found(repair.repair_conversations(strings, damage=False)) == {"5": kept}


def test_turns_all_null(spark):
    rows = [(3, None, "user", "A.", "c", 1, True, 1), (3, None, "assistant", "B.", "c", 1, True, 1)]
    got = found(repair.repair_conversations(spark.createDataFrame(rows, ROWS), damage=False))[3]
    assert got[0] == 0 and got[4:7] == (0, 2, "IKKI")  # by role: the assistant's turn first
