"""Byte-level BPE encoding and decoding by the ranks of a vocabulary file.

The tokenizers library works on characters, so bytes are first mapped to printable characters, one each; ids
are then found by its BPE model over Arrow batches. Decoding needs no library: an id stands for bytes, and
the bytes of a text put together are the text, also where a character was split over several ids.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from folioworks.llm.common import kept_in_process, parts
from folioworks.llm.token_cache import PieceCache, byte_characters, encode_column, gather, in_bytes, piece_encoder

SLICE_BYTES = 2 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, which is their id, from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def build_tokenizer(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """A tokenizer that merges by ``ranks`` within each match of ``pattern``.

    The rank rule joins any two neighbours whose bytes together are a token, lowest rank first. So every way
    of cutting a token into two tokens is a merge, in order of the token's rank; a match that is itself a
    token is taken whole.
    """
    signs = byte_characters()
    written = {token: "".join(signs[b] for b in token) for token in ranks}
    merges = [
        (written[token[:cut]], written[token[cut:]])
        for token in sorted(ranks, key=ranks.get)
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    model = models.BPE(
        vocab={written[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=0
    )
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return tokenizer


class Codec:
    """Encoder and decoder of one vocabulary; a Python worker keeps one."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = build_tokenizer(ranks, pattern)
        letters = in_bytes()
        self.cache = PieceCache(piece_encoder(tokenizer, lambda piece: piece.translate(letters)))
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        self.table = np.frombuffer(b"".join(table), np.uint8)
        self.lengths = np.fromiter(map(len, table), np.int64, len(table))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return encode_column(texts, self.cache)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, one after another, and the end of each id in them."""
        return gather(self.table, self.lengths, ids.astype(np.int64))


def character_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First character of each id: an id that begins inside a character counts as beginning with it."""
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    inside = (data[np.minimum(starts, len(data) - 1)] & 0xC0) == 0x80 if len(data) else np.zeros(len(starts), bool)
    return before[starts] - inside


def _columns(kind: str, n_ids: int, ids: np.ndarray, data: np.ndarray, ends: np.ndarray) -> dict:
    if kind == "digest":
        return {
            "n_tokens": n_ids,
            "ids_sha256": hashlib.sha256(ids.tobytes()).hexdigest(),
            "decoded_sha256": hashlib.sha256(data.tobytes()).hexdigest(),
        }
    return {
        "ids": ids.astype(np.int32),
        "starts": character_starts(data, ends).astype(np.int32),
        "decoded": data.tobytes().decode("utf-8", "replace"),
    }


def _encoded(codec: Codec, piece: pa.RecordBatch, key: str, output: str) -> list[pa.RecordBatch]:
    ids, ends = codec.encode(piece.column("_text"))
    data, byte_ends = codec.decode(ids)
    at, rows = 0, []
    for end in ends:
        low, high = (byte_ends[at - 1] if at else 0), (byte_ends[end - 1] if end else 0)
        rows.append(_columns(output, int(end - at), ids[at:end], data[low:high], byte_ends[at:end] - low))
        at = int(end)
    if not rows:
        return []
    made = pa.Table.from_pylist(rows)
    return pa.table({key: pa.chunked_array([piece.column("_key")]), **{c: made[c] for c in made.column_names}}).to_batches()


OUTPUTS = {
    "tokens": "ids array<int>, starts array<int>, decoded string",
    "digest": "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
}


def encode_decode(
    documents: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", output: str = "tokens"
) -> DataFrame:
    """``key`` and what ``output`` names: ``tokens`` (ids, first character of each id, text decoded from the ids)
    or ``digest`` (number of ids, SHA-256 of the ids as little-endian 32-bit integers and of the decoded bytes).

    One row per input row, repeated rows included; nothing is shuffled. A null or empty text has no ids. The
    key is passed on as it is, null or repeated; other columns are not read. ``ranks_path`` is read on the
    driver (a vocabulary, one or two megabytes) and sent along with the tasks.
    """
    ranks, label = read_ranks(ranks_path), f"byte_bpe_{abs(hash((ranks_path, pattern)))}"
    regex.compile(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept_in_process(label, lambda: Codec(ranks, pattern)) as codec:
            for batch in batches:
                for piece in parts(batch, "_text", SLICE_BYTES):
                    yield from _encoded(codec, piece, key, output)

    source = documents.select(documents[key].alias("_key"), documents[text].alias("_text"))
    kind = documents.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, {OUTPUTS[output]}")
