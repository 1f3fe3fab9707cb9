"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import threading
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of the contracts: runs of anything but space and the five ASCII control spaces.
WORD_GAP = r"[\x20\x09-\x0D]+"


def words_of(text: Column | str) -> Column:
    """Words of a text as an array; a null text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(column, F.lit("")), WORD_GAP), lambda w: w != "")


IDLE_SECONDS = 5.0


def trim() -> None:
    """Give freed memory back to the system, where its C library can."""
    gc.collect()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


@contextmanager
def kept_in_process(name: str, make: Callable[[], Any], idle: float = IDLE_SECONDS) -> Iterator[Any]:
    """A value that tasks of one Python worker share; when none has used it for ``idle`` seconds, it goes."""
    store = sys.modules.setdefault("_folioworks_process_state", types.ModuleType("_folioworks_process_state"))
    lock = vars(store).setdefault("lock", threading.RLock())
    with lock:
        if not hasattr(store, name):
            setattr(store, name, {"value": make(), "users": 0, "turn": 0})
        entry = getattr(store, name)
        entry["users"] += 1
        entry["turn"] += 1

    def drop(turn: int) -> None:
        with lock:
            if getattr(store, name, None) is entry and not entry["users"] and entry["turn"] == turn:
                delattr(store, name)
                entry.clear()
        trim()

    try:
        yield entry["value"]
    finally:
        with lock:
            entry["users"] -= 1
            if not entry["users"]:
                timer = threading.Timer(idle, drop, [entry["turn"]])
                timer.daemon = True
                timer.start()


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.large_binary()).to_pylist()


def parts(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most`` bytes of text; a longer text is a slice of its own."""
    sizes = np.asarray(batch.column(column).cast(pa.large_binary()).fill_null(b"").to_numpy(zero_copy_only=False))
    ends = np.cumsum(np.fromiter(map(len, sizes), np.int64, len(sizes)))
    start, n = 0, batch.num_rows
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def spread_out(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place within the owner of each of ``counts.sum()`` items laid out one owner after another."""
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, place
