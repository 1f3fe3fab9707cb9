"""Token ids in binary shard files with a minimal perfect hash index from document key to place.

Layout of a shard file, all integers little-endian; a reader starts from the footer, as files are only appended to:

    payload      the ids of all documents of the shard, document by document, in key order
    documents    per document the number of its ids (64 bits)
    levels       the bits of all levels of the hash, each level padded to 64
    slots        per key: fingerprint (32 bits), zero (32 bits), key (64 bits), first document (64 bits), number of
                 documents with this key (64 bits)
    sizes        bits of each level (64 bits)
    footer       documents, documents without key (they come first), keys, ids, bytes per id, levels (64 bits each),
                 zero (64 bits), magic b"FWTOKS01"

The hash is built in levels: a key takes the bit its hash names on the first level where no other key of the
shard names the same bit, and its slot is the number of bits set up to there. Every slot is used and a lookup
reads a bounded number of bits: constant time. A key that is not in the shard is told by the fingerprint and
the key in its slot.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from folioworks.llm.common import kept_in_process, parts
from folioworks.llm.token_cache import PieceCache, encode_column, whole_encoder, word_encoder
from folioworks.session import materialise, qualified

MAGIC = b"FWTOKS01"
FOOTER = 64
SLICE_BYTES = 4 << 20
BITS_PER_KEY = 2
PRINT_SALT = 65_535
MANIFEST = "file string, shard bigint, n_docs bigint, n_tokens bigint, low bigint, high bigint"
SLOT = np.dtype([("print", "<u4"), ("zero", "<u4"), ("key", "<i8"), ("first", "<u8"), ("count", "<u8")])


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of integer keys (the finaliser of SplitMix64 over key and salt)."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 .. n-1 for n distinct integer keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before, at = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(at + np.cumsum(ones) - ones)
            at += int(ones.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = 64 * -(-BITS_PER_KEY * len(left) // 64)
            at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level holds it (then it was not among the keys)."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for salt, (words, before) in enumerate(zip(self.levels, self.before)):
            at = mixed(keys[open_], salt) % np.uint64(64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            held = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[held]] = (before[word] + np.bitwise_count(below))[held]
            open_ = open_[~held]
        return out


class Encoder:
    """Ids of whole texts by a tokenizer file, each text closed by ``end_id``."""

    def __init__(self, tokenizer_json: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_str(tokenizer_json)
        shape = tokenizer.to_str()
        self.end_id, self.lower = end_id, '{"type":"Lowercase"}' in shape
        ending = json.loads(shape)["model"].get("end_of_word_suffix")
        self.cache = PieceCache(word_encoder(tokenizer, ending) if self.lower and ending else whole_encoder(tokenizer))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, ends = encode_column(texts, self.cache, self.lower)
        return np.insert(ids, ends, self.end_id), ends + np.arange(1, len(ends) + 1)


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path there; any shared store that Arrow knows by the scheme of ``path``."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _index(sink, keys: np.ndarray, n_null: int, counts: np.ndarray, width: int) -> None:
    """Write everything that follows the payload."""
    own = keys[n_null:]
    unique, first, repeats = np.unique(own, return_index=True, return_counts=True)
    table = PerfectHash.build(unique)
    slots = np.zeros(len(unique), SLOT)
    at = table.slots(unique)
    slots["print"][at] = (mixed(unique, PRINT_SALT) >> np.uint64(32)).astype("<u4")
    slots["key"][at], slots["first"][at], slots["count"][at] = unique, first + n_null, repeats
    sink.write(counts.astype("<u8").tobytes())
    for words in table.levels:
        sink.write(words.tobytes())
    sink.write(slots.tobytes())
    sink.write(np.array([64 * len(w) for w in table.levels], "<u8").tobytes())
    sizes = [len(counts), n_null, len(unique), int(counts.sum()), width, len(table.levels), 0]
    sink.write(np.array(sizes, "<u8").tobytes() + MAGIC)


class Shard:
    """An open shard file. The index is read at once, payloads only where asked for."""

    def __init__(self, path: str):
        store, where = _store(path)
        self.file = store.open_input_file(where)
        size = self.file.size()
        footer = self._bytes(size - FOOTER, FOOTER)
        if footer[-8:] != MAGIC:
            raise ValueError(f"{path} is not a shard file")
        docs, self.n_null, keys, ids, width, levels, _ = np.frombuffer(footer[:-8], "<u8").astype(int)
        self.type = np.dtype(f"<u{width}")
        self.counts = np.frombuffer(self._bytes(ids * width, 8 * docs), "<u8").astype(np.int64)
        self.ends = np.cumsum(self.counts)
        bits = np.frombuffer(self._bytes(size - FOOTER - 8 * levels, 8 * levels), "<u8").astype(int)
        at, words = ids * width + 8 * docs, []
        for n in bits:
            words.append(np.frombuffer(self._bytes(at, n // 8), "<u8"))
            at += n // 8
        self.hash = PerfectHash(words)
        self.slots = np.frombuffer(self._bytes(at, keys * SLOT.itemsize), SLOT)

    def _bytes(self, at: int, n: int) -> bytes:
        return self.file.read_at(int(n), int(at)) if n else b""

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; number 0 where the shard lacks the key."""
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        slots = self.hash.slots(keys)
        at = np.flatnonzero(slots >= 0)
        entry = self.slots[slots[at]]
        good = entry["print"] == (mixed(keys[at], PRINT_SALT) >> np.uint64(32)).astype("<u4")
        good &= entry["key"] == keys[at]
        first[at[good]], count[at[good]] = entry["first"][good], entry["count"][good]
        return first, count

    def read(self, first: int, count: int) -> list[np.ndarray]:
        """Ids of consecutive documents."""
        low = int(self.ends[first - 1]) if first else 0
        ends = self.ends[first : first + count]
        total = int(ends[-1]) - low if count else 0
        ids = np.frombuffer(self._bytes(low * self.type.itemsize, total * self.type.itemsize), self.type)
        return np.split(ids, (ends - low)[:-1]) if count else []


class TokenReader:
    """Keyed access over all shards, for a training process: ``get`` reads only the documents of its key."""

    def __init__(self, folder: str, manifest: list):
        self.folder, self.open = folder, {}
        self.rows = sorted((r for r in manifest if r["low"] is not None), key=lambda r: r["shard"])
        self.highs = [r["high"] for r in self.rows]

    def get(self, key: int) -> list[np.ndarray]:
        out = []
        for row in self.rows[bisect_left(self.highs, key) :]:
            if row["low"] > key:
                break
            shard = self.open.setdefault(row["file"], None) or Shard(f"{self.folder}/{row['file']}")
            self.open[row["file"]] = shard
            (first,), (count,) = shard.find(np.array([key], np.int64))
            out += shard.read(int(first), int(count))
        return out


def write_shards(
    documents: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = 1,
    key: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """Encode ``text`` and write shard files under ``folder``; returns the manifest, one row per shard file.

    Shards follow each other in ascending key order (null keys first). Rows that share a key follow each other in
    the order of a hash of their text; a key held by many rows may reach over several shards, each of which then
    indexes its own part. A null or empty text is one document that holds the end id only; an empty table has no
    shard. The key must be a whole number. Names of special tokens in a text become these tokens, as in the library. Other columns are not read. Every attempt of a task writes a file of its own, and the manifest, written
    to the shared folder, names the files that count, so lost or repeated tasks do no harm. ``tokenizer_path`` is
    read on the driver (a vocabulary of a few megabytes) and sent along with the tasks.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    label = f"encoder_{abs(hash((tokenizer_path, end_id)))}"
    highest = max(end_id, Tokenizer.from_str(tokenizer_json).get_vocab_size() - 1)
    width = np.dtype("<u2" if highest < 65_536 else "<u4")

    folder = qualified(documents.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        number = TaskContext.get().partitionId()
        name = f"shard-{number:07d}-{uuid.uuid4().hex}"
        keys, counts, n_null, sink = [], [], 0, None
        with kept_in_process(label, lambda: Encoder(tokenizer_json, end_id)) as encoder:
            for batch in batches:
                for piece in parts(batch, "_text", SLICE_BYTES):
                    ids, ends = encoder.encode(piece.column("_text"))
                    if sink is None:
                        store.create_dir(root, recursive=True)
                        sink = store.open_output_stream(f"{root}/{name}")
                    sink.write(ids.astype(width).tobytes())
                    column = piece.column("_key")
                    n_null += column.null_count
                    keys.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                    counts.append(np.diff(ends, prepend=0))
        if sink is None:
            return
        key_of, count = np.concatenate(keys), np.concatenate(counts)
        _index(sink, key_of, n_null, count, width.itemsize)
        sink.close()
        low, high = (int(key_of[n_null]), int(key_of[-1])) if n_null < len(key_of) else (None, None)
        row = {"file": name, "shard": number, "n_docs": len(count), "n_tokens": int(count.sum()), "low": low, "high": high}
        yield pa.RecordBatch.from_pylist([row], arrow_manifest)

    arrow_manifest = to_arrow_schema(documents.sparkSession.createDataFrame([], MANIFEST).schema)
    source = documents.select(
        documents[key].cast("bigint").alias("_key"), documents[text].alias("_text"), F.xxhash64(documents[text]).alias("_tie")
    )
    ranged = source.repartitionByRange(*([shards] if shards else []), "_key", "_tie")
    ordered = ranged.sortWithinPartitions("_key", "_tie").select("_key", "_text")
    return materialise(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame, folder: str, key: str = "doc_id", block: int = 4096) -> DataFrame:
    """Every document of the shard files, found by its key through the index: ``key``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids_crc32`` (of the ids as little-endian 32-bit integers).

    One task reads one shard or several, each in blocks of ``block`` documents.
    """
    folder = qualified(manifest.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            shard = Shard(f"{folder}/{row['file']}")
            keys = shard.slots["key"][np.argsort(shard.slots["first"])]
            spans = [(None, 0, shard.n_null)] if shard.n_null else []
            for at in range(0, len(keys), block):
                first, count = shard.find(keys[at : at + block])
                if (count == 0).any():
                    raise ValueError(f"index of {row['file']} has lost a key")
                spans += zip(keys[at : at + block].tolist(), first.tolist(), count.tolist())
            for at in range(0, len(spans), block):
                owners, firsts, counts = zip(*spans[at : at + block])
                for low in range(firsts[0], firsts[-1] + counts[-1], block):
                    n = min(block, firsts[-1] + counts[-1] - low)
                    docs = shard.read(low, n)
                    begin = row["before"] + shard.ends[low : low + n] - shard.counts[low : low + n]
                    which = np.searchsorted(firsts, np.arange(low, low + n), side="right") - 1
                    yield pa.record_batch({
                        key: pa.array([owners[i] for i in which], pa.int64()),
                        "start": pa.array(begin, pa.int64()),
                        "n_tokens": pa.array([len(d) for d in docs], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(d.astype("<u4").tobytes()) for d in docs], pa.int64()),
                    })

    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard file
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    rows = placed.select("file", "before").repartition("file")
    return rows.mapInArrow(run, f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
