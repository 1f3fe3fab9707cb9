"""Repair of the turn structure of conversations, at least cost, by dynamic programming over runs.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Every row is a symbol (initial of its role, whether
it must go, whether it is truncated), and a symbol is a min-plus matrix over the states of that pattern: the cost of
getting from one state to another while the row is kept, given another role or deleted, with insertions before it. Equal symbols
in a row form a run; a run is crossed by the cached binary powers of its matrix, so a conversation costs as many steps as it
has runs (times a logarithm). Then the choices are unrolled row by row, the ASCII-least letter among the cheapest first.

How the rows travel: turns are sorted by range, so that one conversation, however long, is spread over tasks;
each task packs the symbols of its part of a conversation into runs, and only these packed runs meet in one place. The texts
cross the network once more for the digest of the repaired conversation, in order and one batch at a time, behind the
row that carries the audit. What a task holds of a conversation is thus no more than its audit, which the result holds, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.session import materialise

# Fixed values of the contract: costs of the edits, and what counts as content and as an end of a sentence.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANKS, ENDS = "\x20\x09\x0a\x0b\x0c\x0d", ".!?"
INFINITE = 1 << 60
# States: nothing yet, after the system's turn, after a user's turn, after an assistant's turn. The first and last may end.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
FINAL = (0, INFINITE, INFINITE, 0)
# From a state, where the next initial leads; ``NEXT`` is the only role that may be given or inserted there.
MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
# A symbol is four times the initial's number plus its fault.
INITIALS = "sua"
OTHER = len(INITIALS)
SOUND, CUT, BLANK, DUPLICATE = range(4)

Vector = tuple[int, int, int, int]


# -- runs ------------------------------------------------------------------------------------------------------------


def symbol(initial: str, fault: int) -> int:
    return 4 * (INITIALS.index(initial) if initial in INITIALS and initial else OTHER) + fault


def _after(state: int, letter: str, sym: int) -> int | None:
    """The state that a kept or re-roled row, or an insertion, leads to."""
    if letter == "K":
        initial = INITIALS[sym >> 2] if sym >> 2 < OTHER else ""
        return MOVES.get((state, initial))
    return MOVES[state, NEXT[state][0]]


def _edits(sym: int) -> list[tuple[str, int]]:
    """Edits that use up a row of this symbol, with their costs."""
    fault = sym & 3
    if fault >= BLANK:
        return [("D", DELETE)]
    return [("D", DELETE), ("K", fault * TRUNCATED), ("R", REROLE + fault * TRUNCATED)]


def _closed(costs: list[int]) -> Vector:
    """Costs to the end when rows may be inserted first: each pass allows one insertion more, four reach every state."""
    for _ in STATES:
        costs = [min(costs[s], INSERT + costs[_after(s, "I", 0)]) for s in STATES]
    return tuple(min(c, INFINITE) for c in costs)


def _over(sym: int, rest: Vector) -> Vector:
    """Costs to the end from before a row, given those from behind it."""
    costs = []
    for state in STATES:
        ways = [INFINITE]
        for letter, price in _edits(sym):
            to = state if letter == "D" else _after(state, letter, sym)
            if to is not None:
                ways.append(price + rest[to])
        costs.append(min(ways))
    return _closed(costs)


def _times(left: tuple[Vector, ...], right: tuple[Vector, ...]) -> tuple[Vector, ...]:
    columns = list(zip(*right))
    return tuple(tuple(min(INFINITE, min(map(int.__add__, row, column))) for column in columns) for row in left)


@lru_cache(maxsize=None)
def power(sym: int, bit: int) -> tuple[Vector, ...]:
    """The min-plus matrix of ``2 ** bit`` rows of one symbol; there are 16 symbols and at most 63 bits."""
    if bit:
        half = power(sym, bit - 1)
        return _times(half, half)
    unit = [_over(sym, tuple(0 if s == to else INFINITE for s in STATES)) for to in STATES]
    return tuple(zip(*unit))


def crossed(sym: int, length: int, rest: Vector) -> Vector:
    """Costs to the end from before a run of equal rows, given those from behind it."""
    bit = 0
    while length:
        if length & 1:
            rest = tuple(min(INFINITE, min(map(int.__add__, row, rest))) for row in power(sym, bit))
        length >>= 1
        bit += 1
    return rest


def repair(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Least cost and audit of a conversation given as ``(symbol, length)`` runs."""
    behind = [_closed(list(FINAL))]
    for sym, length in reversed(runs):
        behind.append(crossed(sym, length, behind[-1]))
    behind.reverse()
    state, letters = START, []
    for (sym, length), rest in zip(runs, behind[1:]):
        state = _unroll(sym, length, rest, state, letters)
    while behind[-1][state] != 0:  # only insertions are left
        letters.append("I")
        state = _after(state, "I", 0)
    return behind[0][START], "".join(letters)


def _unroll(sym: int, length: int, rest: Vector, state: int, letters: list[str]) -> int:
    """Append the choices inside one run, and return the state behind it.

    The costs in front of every remaining row of a run soon repeat up to a constant; the choice depends on their
    differences only, so it is looked up by state and differences.
    """
    # Costs from before the last k rows of the run, k = 0, 1, ...; kept for as long as their differences still change.
    tail = [rest]
    shapes = {_shape(rest): 0}
    while len(tail) <= length:
        now = _over(sym, tail[-1])
        shape = _shape(now)
        if shape in shapes:
            break
        shapes[shape] = len(tail)
        tail.append(now)
    first, cycle = (shapes[shape], len(tail) - shapes[shape]) if len(tail) <= length else (0, 0)

    def place(k: int) -> int:
        return k if k < len(tail) else first + (k - first) % cycle

    chosen: dict[tuple[int, int, int], tuple[str, int]] = {}
    left = length
    while left:
        at, before = place(left), place(left - 1)
        if (choice := chosen.get((at, before, state))) is None:
            here, there = tail[at], tail[before]
            if at != before + 1:  # round the cycle: bring the neighbour to the same level
                there = _level(sym, here, there)
            choice = chosen[at, before, state] = _choice(sym, state, here, there)
        letters.append(choice[0])
        state = choice[1]
        left -= choice[0] != "I"
    return state


def _choice(sym: int, state: int, here: Vector, there: Vector) -> tuple[str, int]:
    """The least letter of a cheapest way across a row, and where it leads; costs before and behind the row."""
    for letter, price in sorted([*_edits(sym), ("I", INSERT)]):
        to = state if letter == "D" else _after(state, letter, sym)
        if to is not None and price + (here if letter == "I" else there)[to] == here[state]:
            return letter, to
    raise AssertionError("a cheapest way has a first edit")


def _shape(costs: Vector) -> Vector:
    least = min(costs)
    return tuple(c - least if c < INFINITE else INFINITE for c in costs)


def _level(sym: int, here: Vector, there: Vector) -> Vector:
    """``there`` moved by a constant, so that crossing one row from it gives ``here``."""
    shift = min(here) - min(_over(sym, there))
    return tuple(c + shift if c < INFINITE else INFINITE for c in there)


@lru_cache(maxsize=1 << 14)
def _repair_short(packed: bytes) -> tuple[int, str]:
    return repair(unpack(packed))


def pack(runs: list[tuple[int, int]]) -> bytes:
    """Runs as bytes: the symbol, then its length in groups of seven bits."""
    out = bytearray()
    for sym, length in runs:
        out.append(sym)
        while length > 127:
            out.append(length & 127 | 128)
            length >>= 7
        out.append(length)
    return bytes(out)


def unpack(packed: bytes) -> list[tuple[int, int]]:
    runs, at = [], 0
    while at < len(packed):
        sym, length, shift, at = packed[at], 0, 0, at + 1
        while packed[at] & 128:
            length |= (packed[at] & 127) << shift
            shift, at = shift + 7, at + 1
        runs.append((sym, length | packed[at] << shift))
        at += 1
    return runs


def joined(pieces: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """Runs of pieces that follow each other; a run that a border cuts becomes one again."""
    runs: list[tuple[int, int]] = []
    for piece in pieces:
        for sym, length in piece:
            if runs and runs[-1][0] == sym:
                runs[-1] = (sym, runs[-1][1] + length)
            else:
                runs.append((sym, length))
    return runs


# -- rows ------------------------------------------------------------------------------------------------------------


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text``: every row after the damage that its key calls for; a null role or text is one space."""
    c, t = rows[conv], rows[turn]
    spaced = [F.coalesce(x.cast("string"), F.lit(" ")) for x in (c, t)]
    kind = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1])) % 20
    said = F.coalesce(rows[text], F.lit(" "))
    now = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(said, r"[.!?]", "")).otherwise(said)
    who = F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(rows[role], F.lit(" ")))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = rows.select(c.alias("conv"), t.alias("turn"), who.alias("role"), now.alias("text"), times.alias("times"), kind.alias("kind"))
    return kept.where("kind <> 0").withColumn("_copy", F.explode("times")).select("conv", "turn", "role", "text")


def _key() -> Column:
    """Role and text of a row as 128 bits."""
    return F.struct(*(F.xxhash64(F.lit(seed), "role", "text").alias(f"h{seed}") for seed in (1, 2)))


def _fault() -> Column:
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    return F.when(last == "", BLANK).when(~last.isin(*ENDS), CUT).otherwise(SOUND)


def _packed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each stretch of a conversation in this task's range, in order: its runs, packed."""
    part = TaskContext.get().partitionId()
    kind, who, runs, held = pa.int64(), None, [], []

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*held), (kind, pa.bool_(), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "none", "piece", "runs"])

    for rows in batches:
        kind = rows.column("conv").type
        for c, n, sym, more in zip(*(rows.column(x).to_pylist() for x in ("conv", "none", "sym", "more"))):
            if (c, n) != who:
                if runs:
                    held.append((*who, part, pack(joined([runs]))))
                who, runs = (c, n), []
            runs.append((sym, 1))
            if more:
                runs.append((sym & ~3 | (BLANK if sym & 3 == BLANK else DUPLICATE), more))
            if len(runs) >= 4096:
                runs = joined([runs])
        if len(held) >= 4096:
            yield batch()
            held = []
    if runs:
        held.append((*who, part, pack(joined([runs]))))
    if held:
        yield batch()


def _counts(runs: list[tuple[int, int]]) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours whose initials may not follow each other."""
    by = [0, 0, 0, 0]
    illegal, before = 0, None
    for sym, length in runs:
        by[sym & 3] += length
        initial = sym >> 2
        # Initials of equal kind never follow each other.
        illegal += length - 1 + (before is not None and (before, initial) not in ((0, 1), (1, 2), (2, 1)))
        before = initial
    return by[BLANK], by[DUPLICATE], by[CUT], illegal


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    for rows in batches:
        out = []
        for pieces in rows.column("pieces").to_pylist():
            packed = pieces[0]["runs"] if len(pieces) == 1 else pack(joined([unpack(p["runs"]) for p in pieces]))
            runs = unpack(packed)
            cost, audit = _repair_short(packed) if len(packed) <= 64 else repair(runs)
            out.append((*_counts(runs), cost, audit))
        if out:
            found = [pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 5 + [pa.string()])]
            yield pa.RecordBatch.from_arrays([rows.column("conv"), rows.column("none"), *found], names=["conv", "none", *names])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each repaired conversation: its audit comes first, then its rows in order; one batch is held at a time."""
    conv, none, audit, at, state, digest, open_ = None, None, "", 0, START, None, False
    done: list[tuple] = []

    def put(role: str, text: str) -> None:
        nonlocal open_
        digest.update(("\n" if open_ else "").encode() + f"{role}:{text}".encode())
        open_ = True

    def insert() -> None:
        """Insertions that come next in the audit."""
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            put(NEXT[state], "")
            state, at = _after(state, "I", 0), at + 1

    def close() -> None:
        if digest is not None:
            insert()
            done.append((conv, none, digest.hexdigest()))

    def batch(kind: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*done), (kind, pa.bool_(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "none", "repaired_sha256"])

    kind = pa.int64()
    for rows in batches:
        kind = rows.column("conv").type
        for c, n, is_row, role, text in zip(*(rows.column(x).to_pylist() for x in ("conv", "none", "is_row", "role", "text"))):
            if not is_row:
                close()
                conv, none, audit, at, state, digest, open_ = c, n, text, 0, START, hashlib.sha256(), False
                continue
            insert()
            letter, at = audit[at], at + 1
            if letter == "K":
                put(role, text)
                state = _after(state, "K", symbol(role[:1], SOUND))
            elif letter == "R":
                put(NEXT[state], text)
                state = _after(state, "R", 0)
        if len(done) >= 4096:
            yield batch(kind)
            done = []
    close()
    if done:
        yield batch(kind)


def repair_conversations(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = True,
) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for every conversation.

    With ``damage`` rows are first damaged by a checksum of their key; without, they are taken as they are. Rows
    of a conversation follow each other by turn (null turns first), then role, then a hash of role and text; rows that repeat
    are all there, all but the first being duplicates. A null role or text is one space, so the text is blank and the role's initial fits
    nowhere. Rows without a conversation id form one conversation, returned with a null id. A conversation left
    without rows gets zeros and the digest of nothing; an empty table gives no rows. Other columns are not read. A
    conversation id may be a whole number or a string, a turn is a whole number.
    """
    every = conversations.select(conversations[conv].alias("conv")).distinct()
    if damage:
        rows = damaged(conversations, conv, turn, role, text)
    else:
        blank = [F.coalesce(conversations[c], F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
        rows = conversations.select(conversations[conv].alias("conv"), conversations[turn].alias("turn"), *blank)
    id_type = rows.schema["conv"].dataType.simpleString()
    if id_type != "string":
        rows = rows.withColumn("conv", F.col("conv").cast("bigint"))
        every = every.withColumn("conv", F.col("conv").cast("bigint"))
        id_type = "bigint"
    nothing = F.lit("") if id_type == "string" else F.lit(0)
    # A null id becomes a flag beside a plain value, so that it can be a join key.
    flagged = [F.coalesce("conv", nothing.cast(id_type)).alias("conv"), F.col("conv").isNull().alias("none")]
    rows = rows.select(*flagged, "turn", "role", "text")
    who = ["conv", "none"]

    # Rows that repeat at one turn are counted first, so that no row is too frequent: the first of them stands for itself,
    # the rest are a run of duplicates. Where a role and text occur at several turns, the first of these is noted.
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    narrow = rows.select(*who, "turn", "role", _key().alias("h"), (kind * 4 + _fault()).cast("int").alias("sym"))
    narrow = materialise(narrow.groupBy(*who, "turn", "role", "h", "sym").agg(F.count(F.lit(1)).alias("n")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    firsts = narrow.groupBy(*who, "h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = materialise(firsts.select(*who, "h", "first"), "first-turns")
    again = (place > F.col("first")) & (F.col("sym") % 4 != BLANK)
    sym = F.when(again, F.col("sym") - F.col("sym") % 4 + DUPLICATE).otherwise(F.col("sym")).alias("sym")
    order = [*who, F.col("turn").asc_nulls_first(), "role", "h"]
    symbols = narrow.join(firsts, [*who, "h"], "left").select(*who, "turn", "role", "h", sym, (F.col("n") - 1).alias("more"))
    runs = symbols.repartitionByRange(*order).sortWithinPartitions(*order).select(*who, "sym", "more")
    pieces = runs.mapInArrow(_packed_runs, f"conv {id_type}, none boolean, piece bigint, runs binary")
    pieces = materialise(pieces, "turn-runs").groupBy(*who).agg(F.array_sort(F.collect_list(F.struct("piece", "runs"))).alias("pieces"))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    audits = materialise(
        pieces.mapInArrow(_audits, f"conv {id_type}, none boolean, " + ", ".join(f"{c} bigint" for c in counts) + ", audit string"), "audits"
    )

    # The audit leads the rows of its conversation.
    lead = audits.select(*who, F.lit(False).alias("is_row"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    full = rows.select(*who, F.lit(True).alias("is_row"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    keyed = lead.union(full).withColumn("h", _key())
    stream = keyed.repartition(*who).sortWithinPartitions(*who, "is_row", F.col("turn").asc_nulls_first(), "role", "h")
    digests = stream.select(*who, "is_row", "role", "text").mapInArrow(_digests, f"conv {id_type}, none boolean, repaired_sha256 string")

    numbers = narrow.groupBy(*who).agg(F.max("turn").alias("high"), F.min("turn").alias("low"))
    distinct = narrow.where("turn IS NOT NULL").select(*who, "turn").distinct().groupBy(*who).agg(F.count(F.lit(1)).alias("n"))
    gaps = numbers.join(distinct, who, "left").select(*who, F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0)).cast("bigint").alias("gaps"))
    result = every.select(*flagged).join(gaps, who, "left").join(audits, who, "left").join(digests, who, "left")
    return result.select(
        F.when(~F.col("none"), F.col("conv")).alias(conv),
        *(F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ("gaps", *counts)),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
