"""Filter interaction audit over sorted posting lists.

What would each filter of a set remove, in every order in which the filters can be applied? The documents are dealt by
ranges of their ids; in a range, every part (a language, say) keeps the sorted list of the ids that fail, one list a filter.
Unions of the lists of earlier filters, and what a list adds to such a union, come from galloping merges: the list
that lies behind catches up with the others by doubling steps, so that a stretch met by one list only costs its logarithm.
Sizes of all ranges are summed; the documents themselves are read once, and no list leaves its range.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.llm.common import as_bytes, parts
from folioworks.session import materialise

SLICE_BYTES = 4 << 20
# Ids of one posting block.
BLOCK_ROWS = 1 << 16
# The five filters of the audit, and the characters that the fourth one looks for.
FILTERS = "ABCDE"
MARKS = b"#$%&*|"
_CAPITAL, _MARK = (np.zeros(256, bool) for _ in range(2))
_CAPITAL[ord("A") : ord("Z") + 1] = True
_MARK[list(MARKS)] = True


# -- lists ---------------------------------------------------------------------------------------------------------


def gallop(ids: Sequence[int], start: int, value: int) -> int:
    """The first place from ``start`` on whose id is ``value`` or more: doubling steps, then a bisection of the last."""
    end = len(ids)
    if start >= end or ids[start] >= value:
        return start
    step, low = 1, start
    while low + step < end and ids[low + step] < value:
        low += step
        step *= 2
    return bisect_left(ids, value, low + 1, min(low + step, end))


def union(lists: Sequence[Sequence[int]]) -> list[int]:
    """Ids in any of the sorted lists, by a k-way merge that copies whole stretches of the list whose head is least."""
    live = [[ids[0], ids, 0] for ids in lists if ids]
    out: list[int] = []
    while len(live) > 1:
        live.sort(key=lambda head: head[0])
        first, second = live[0], live[1]
        if first[0] == second[0]:
            stop = first[2] + 1  # in both: the other list brings it
        else:
            stop = gallop(first[1], first[2], second[0])
            out += first[1][first[2] : stop]
        if stop == len(first[1]):
            del live[0]
        else:
            first[0], first[2] = first[1][stop], stop
    if live:
        out += live[0][1][live[0][2] :]
    return out


def difference(ids: Sequence[int], others: Sequence[int]) -> list[int]:
    """Ids that are not in ``others``; both sorted."""
    out: list[int] = []
    at, place, n, m = 0, 0, len(ids), len(others)
    while at < n:
        place = gallop(others, place, ids[at])
        if place == m:
            out += ids[at:]
            break
        if others[place] == ids[at]:
            at += 1
            place += 1
        else:
            stop = gallop(ids, at, others[place])
            out += ids[at:stop]
            at = stop
    return out


def common(ids: Sequence[int], others: Sequence[int]) -> int:
    """How many ids are in both sorted lists."""
    few, many = (ids, others) if len(ids) <= len(others) else (others, ids)
    found, place, m = 0, 0, len(many)
    for value in few:
        place = gallop(many, place, value)
        if place == m:
            break
        if many[place] == value:
            found += 1
            place += 1
    return found


def subsets(filters: str) -> list[str]:
    """All sets of filters, as sorted strings."""
    return ["".join(c) for size in range(len(filters) + 1) for c in combinations(filters, size)]


def block_sizes(lists: dict[str, list[int]], good: list[int], toxic: list[int]) -> list[tuple[str, str, int, int, int]]:
    """``(earlier filters, filter, removed, good among them, toxic among them)`` for one block of one part."""
    names = "".join(sorted(lists))
    seen: dict[str, list[int]] = {}
    sizes = []
    for earlier in subsets(names):
        # A set of three or more lists is its first lists' union, merged with the rest.
        seen[earlier] = union([seen[earlier[:-1]], lists[earlier[-1]]]) if len(earlier) > 2 else union([lists[f] for f in earlier])
        for name in names:
            if name not in earlier:
                gone = difference(lists[name], seen[earlier]) if earlier else lists[name]
                sizes.append((earlier, name, len(gone), common(gone, good), common(gone, toxic)))
    return sizes


# -- jobs ----------------------------------------------------------------------------------------------------------


def _signals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Failures of the filters that look at one text, a digest of it, and the row's place in its task."""
    place = 0
    for whole in batches:
        for batch in parts(whole, "text", SLICE_BYTES):
            fails, digests = [], []
            for text in as_bytes(batch.column("text")):
                text = text or b""
                words = text.split()  # bytes: splits at the space and the five control spaces of ASCII, nothing else
                codes = np.frombuffer(text, np.uint8)
                points = len(codes) - int(np.count_nonzero((codes & 0xC0) == 0x80))
                fails.append(
                    (len(words) < 200)
                    | (100 * len(set(words)) < 50 * len(words)) << 1
                    | (100 * int(np.count_nonzero(_CAPITAL[codes])) > 3 * points) << 2
                    | bool(_MARK[codes].any()) << 3
                )
                digests.append(hashlib.blake2b(text, digest_size=16).digest())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("part"), pa.array(fails, pa.int32()), pa.array(digests, pa.binary()),
                    pa.array(range(place, place + n), pa.int64()),
                ],
                names=["id", "part", "fails", "digest", "place"],
            )
            place += n


def signals(docs: DataFrame, labels: DataFrame, part: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, part, fails (bits of the filters), good, toxic, place`` for every row of ``docs``, without its text.

    A null text is empty, a null part the empty string. Filter E fails a row whose text stands under a smaller
    key as well; a null key is neither smaller nor larger than another. Rows that repeat a key all count. A label holds
    for every row of its key, and one of several labels of a key is enough; rows without a key have none.
    """
    rows = docs.select(docs[key].alias("id"), F.coalesce(docs[part], F.lit("")).alias("part"), docs[text].alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, part string, fails int, digest binary, place bigint"
    marked = materialise(rows.mapInArrow(_signals, schema), "audit-signals")
    # Few texts stand under several keys; they are written first, so that Spark can split a text that very many rows share.
    firsts = marked.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    firsts = materialise(firsts.select("digest", "first"), "audit-firsts")
    rated = labels.select(labels[key].alias("rated"), "quality", "toxic").where("rated IS NOT NULL").groupBy("rated").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    rated = materialise(rated.where("good OR toxic"), "audit-labels")
    again = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int")
    return (
        marked.join(firsts, "digest", "left")
        .withColumn("fails", F.col("fails") + 16 * again)
        .join(rated, F.col("id") == F.col("rated"), "left")
        .select("id", "part", "fails", *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")), "place")
    )


def _postings(batches: Iterator[pa.RecordBatch], filters: str, rows: int) -> Iterator[pa.RecordBatch]:
    """One row per part and block of ids in order: its lists. A block ends after so many rows of a task."""

    def flush(blocks: dict[str, dict]) -> pa.RecordBatch:
        names = sorted(blocks)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()), pa.array([blocks[p]["n"] for p in names], pa.int64()),
                *(pa.array([blocks[p][f] for p in names], pa.list_(pa.int32())) for f in (*filters, "good", "toxic")),
            ],
            names=["part", "n", *filters, "good", "toxic"],
        )

    blocks: dict[str, dict] = {}
    at = 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "fails", "good", "toxic"))
        for name, fails, good, toxic in zip(*columns):
            block = blocks.get(name)
            if block is None:
                block = blocks[name] = {"n": 0, "good": [], "toxic": []} | {f: [] for f in filters}
            block["n"] += 1
            for bit, f in enumerate(filters):
                if fails >> bit & 1:
                    block[f].append(at)
            if good:
                block["good"].append(at)
            if toxic:
                block["toxic"].append(at)
            at += 1
            if at == rows:
                yield flush(blocks)
                blocks, at = {}, 0
    if blocks:
        yield flush(blocks)


def posting_lists(rows: DataFrame, filters: str = FILTERS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The table of posting lists: ``part, n``, one list a filter, ``good`` and ``toxic``; ids are places in the block.

    Ids are dealt by range; rows of one id are told apart by their place in the task that read them, so no id is too
    frequent for it. A list never holds more than ``block_rows`` ids.
    """
    ordered = rows.repartitionByRange("id", "place").sortWithinPartitions("id", "place").drop("id", "place")
    schema = "part string, n bigint, " + ", ".join(f"{c} array<int>" for c in (*filters, "good", "toxic"))
    return materialise(ordered.mapInArrow(lambda b: _postings(b, filters, block_rows), schema), "audit-postings")


def _sizes(batches: Iterator[pa.RecordBatch], filters: str) -> Iterator[pa.RecordBatch]:
    """Sizes of all differences, summed over the blocks of a batch."""
    for batch in batches:
        sums: dict[str, np.ndarray] = {}
        names: list[tuple[str, str]] = []
        for i, part in enumerate(batch.column("part").to_pylist()):
            lists = {f: batch.column(f)[i].as_py() for f in filters}
            found = block_sizes(lists, batch.column("good")[i].as_py(), batch.column("toxic")[i].as_py())
            names = [row[:2] for row in found]
            sums[part] = sums.get(part, 0) + np.array([row[2:] for row in found], np.int64)
        held = [(p, *name, *map(int, row)) for p, table in sums.items() for name, row in zip(names, table)]
        if held:
            columns = ["part", "earlier", "filter", "removed", "good_lost", "toxic_lost"]
            kinds = [pa.string()] * 3 + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=columns)


def steps(filters: str = FILTERS) -> list[tuple[str, int, str, str, str]]:
    """``(order, step, filter, earlier filters, other filters)`` for every step of every order."""
    return [
        ("".join(order), i + 1, f, "".join(sorted(order[:i])), "".join(sorted(set(filters) - {f})))
        for order in permutations(filters)
        for i, f in enumerate(order)
    ]


def audit(
    docs: DataFrame, labels: DataFrame, part: str = "lang", key: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    One row per part, order of the five filters and step. ``shapley`` is what the step's filter removes, summed over all
    orders. Nulls and repeated rows are taken as in ``signals``; an empty text or one of blanks only fails A alone (and E,
    when repeated). Empty ``docs`` give no rows, empty ``labels`` zeros in ``good_lost`` and ``toxic_lost``. Other columns
    are not read.
    """
    spark = docs.sparkSession
    lists = posting_lists(signals(docs, labels, part, key, text), FILTERS, block_rows)
    rows = lists.groupBy("part").agg(F.sum("n").alias("n"), *(F.sum(F.size(f)).cast("long").alias(f) for f in FILTERS))
    # One row per block is parsed at a time; a batch holds a few blocks.
    sizes = lists.mapInArrow(
        lambda b: _sizes(b, FILTERS), "part string, earlier string, filter string, removed bigint, good_lost bigint, toxic_lost bigint"
    )
    sums = ["removed", "good_lost", "toxic_lost"]
    sizes = materialise(sizes.groupBy("part", "earlier", "filter").agg(*(F.sum(c).alias(c) for c in sums)), "audit-sizes")
    # 600 fixed rows: five filters have 120 orders.
    plan = spark.createDataFrame(steps(FILTERS), "filter_order string, step int, filter string, earlier string, others string")
    unique = sizes.select("part", "filter", F.col("earlier").alias("others"), F.col("removed").alias("unique_fails"))
    # A filter comes at each step of each order with one set before it: weigh that set's difference by its orders.
    weights = plan.groupBy("filter", "earlier").agg(F.count(F.lit(1)).alias("orders"))
    shapley = sizes.join(F.broadcast(weights), ["filter", "earlier"]).groupBy("part", "filter")
    shapley = shapley.agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    failing = rows.select("part", "n", F.explode(F.create_map(*(x for f in FILTERS for x in (F.lit(f), F.col(f))))).alias("filter", "fails"))
    table = (
        sizes.join(F.broadcast(plan), ["filter", "earlier"])
        .join(unique, ["part", "filter", "others"])
        .join(shapley, ["part", "filter"])
        .join(failing, ["part", "filter"])
    )
    # What is kept after a step: all rows but those that it and the steps before it removed.
    gone = F.collect_list(F.struct("step", *sums, "fails", "unique_fails", "shapley"))
    orders = table.groupBy("part", "n", "filter_order").agg(F.array_sort(gone).alias("steps"))
    kept = orders.select("part", "n", "filter_order", "steps", F.explode("steps").alias("s"))
    before = F.aggregate(F.filter("steps", lambda x: x["step"] <= F.col("s.step")), F.lit(0).cast("long"), lambda a, x: a + x["removed"])
    return kept.select(
        "part", "filter_order", "s.step", (F.col("n") - before).alias("kept"), "s.removed",
        (F.col("s.fails") - F.col("s.removed")).alias("redundant"), "s.unique_fails", "s.good_lost", "s.toxic_lost", "s.shapley",
    )
