"""Whole texts through a tokenizer of the tokenizers library, each distinct piece of text once.

A text is cut where both tokenizers in use cut it anyway: before a single space that stands between visible characters of
ASCII or accented letters of Latin-1, on both sides of a single line feed there, and between such a letter and one of ``. , ! ? ; :``.
No match of their patterns reaches over such a cut, so the ids of the pieces, put together, are the ids of the text. Equal pieces of
a slice are found by Arrow's dictionary encoding, and pieces met before come from a cache of bounded size.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, models, pre_tokenizers

# Memory of a worker's pieces, and what a piece takes beside its own bytes (two objects and their place in the table).
PIECES_BYTES, ENTRY_BYTES = 64 << 20, 190
# Pieces encoded at once.
BATCH = 4096
LETTERS = re.compile(r" ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
# Bytes: the first of every letter from U+00C0 to U+00FF, and the second of the two signs among them.
LATIN, SIGNS = 0xC3, (0x97, 0xB7)
Encode = Callable[[list[str]], list[bytes]]


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in printable)
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


def in_bytes() -> dict[int, str]:
    """Letters of plain pieces, and the space, as the characters that stand for their bytes."""
    signs = byte_characters()
    return {32: signs[32]} | {code: signs[LATIN] + signs[code - 0x40] for code in range(0xC0, 0x100)}


def whole_encoder(tokenizer: Tokenizer) -> Encode:
    """Ids of pieces by the whole tokenizer, as bytes."""
    return lambda pieces: [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


def piece_encoder(tokenizer: Tokenizer, written: Callable[[str], str]) -> Encode:
    """Ids of pieces. A piece of letters, after a space perhaps, is one match of the pattern, and goes straight to the
    BPE model in the form that ``written`` gives it; all others go through the whole tokenizer."""
    return _by_kind(whole_encoder(Tokenizer(tokenizer.model)), whole_encoder(tokenizer), written)


def word_encoder(tokenizer: Tokenizer, ending: str) -> Encode:
    """The same for a lower-casing tokenizer whose last token of a word has an ``ending``: the words of many pieces go to the model as
    one text, and are told apart by that."""
    model = json.loads(tokenizer.to_str())["model"]
    merges = [tuple(pair) for pair in model["merges"]]
    direct = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=ending, cache_capacity=0))
    direct.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    whole = whole_encoder(tokenizer)
    last = np.zeros(max(model["vocab"].values()) + 1, bool)
    last[[i for token, i in model["vocab"].items() if token.endswith(ending)]] = True

    def encode(words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(words), 512):
            (found,) = direct.encode_batch_fast([" ".join(words[at : at + 512])], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            data, ends = ids.tobytes(), (4 * np.flatnonzero(last[ids]) + 4).tolist()
            if len(ends) == len(words[at : at + 512]):
                out += [data[low:high] for low, high in zip([0, *ends], ends)]
            else:  # a word without a last token of its own
                out += whole(words[at : at + 512])
        return out

    table = in_bytes()
    return _by_kind(encode, whole, lambda piece: piece.lstrip().lower().translate(table))


def _by_kind(plain: Encode, whole: Encode, written: Callable[[str], str]) -> Encode:
    def encode(pieces: list[str]) -> list[bytes]:
        kinds = [LETTERS.fullmatch(p) is not None for p in pieces]
        short = iter(plain([written(p) for p, is_plain in zip(pieces, kinds) if is_plain]))
        other = iter(whole([p for p, is_plain in zip(pieces, kinds) if not is_plain]))
        return [next(short if is_plain else other) for is_plain in kinds]

    return encode


class PieceCache:
    """Ids by piece in two generations of half of ``PIECES_BYTES``; pieces not met for a generation go."""

    def __init__(self, encode: Encode):
        self.encode, self.young, self.old, self.size = encode, {}, {}, 0

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        young, old, missing, out = self.young, self.old, [], [b""] * len(pieces)
        for i, piece in enumerate(pieces):
            found = young.get(piece)
            if found is None:
                found = old.get(piece)
                if found is None:
                    missing.append(i)
                    continue
                young[piece] = found
                self.size += len(piece) + len(found) + ENTRY_BYTES
            out[i] = found
        for at in range(0, len(missing), BATCH):
            block = missing[at : at + BATCH]
            for i, ids in zip(block, self.encode([pieces[j].decode() for j in block])):
                young[pieces[i]] = out[i] = ids
                self.size += len(pieces[i]) + len(ids) + ENTRY_BYTES
            if self.size > PIECES_BYTES // 2:
                young, self.young, self.old, self.size = {}, {}, young, 0
                young = self.young
        if self.size > PIECES_BYTES // 2:
            self.young, self.old, self.size = {}, young, 0
        return out


def _edges(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces of ``data`` (UTF-8 bytes) begin and end; texts begin and end at ``offsets``."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        here = data[1:-1]
        latin = np.zeros(len(data), bool)  # the last byte of an accented letter
        latin[1:] = (data[:-1] == LATIN) & (data[1:] != SIGNS[0]) & (data[1:] != SIGNS[1])
        plain = (data - np.uint8(33)) < 94
        visible = (plain | latin)[:-2] & (plain | (data == LATIN))[2:]
        line = visible & (here == 10)
        np.logical_or(line, visible & (here == 32), out=cut[1:-2])
        cut[2:-1] |= line
        marks = np.zeros(256, bool)
        marks[np.frombuffer(b".,!?;:", np.uint8)] = True
        cut[1:-2] |= marks[here] & ((((data | 32) - np.uint8(97)) < 26) | latin)[:-2]
    cut[offsets] = True
    return np.flatnonzero(cut)


def _lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z in lower case."""
    return data + ((data - np.uint8(65)) < 26) * np.uint8(32)


def encode_column(texts: pa.Array, cache: PieceCache, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``texts`` one after another, and the end of each text in them; a null text is empty.

    ``lower`` is for tokenizers that lower-case anyway: there are fewer different pieces then.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    # Names of special tokens count as they are written: a slice that may hold one is not lower-cased beforehand.
    lower = lower and not bool(((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any())
    data, offsets = _lowered(data) if lower else data, offsets - offsets[0]
    edges = _edges(data, offsets)
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]
    )
    coded = pieces.dictionary_encode()
    blobs = cache.ids(coded.dictionary.to_pylist())
    flat = np.frombuffer(b"".join(blobs), "<u4")
    lengths = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    which = coded.indices.to_numpy()
    ids, ends = gather(flat, lengths, which)
    # Pieces before each text's end, hence ids before it.
    upto = np.searchsorted(edges, offsets[1:], side="left")
    return ids, np.concatenate([[0], ends])[upto]


def gather(flat: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length entries ``which`` of a flat store, laid out in order, and the end of each."""
    counts = lengths[which]
    ends = np.cumsum(counts)
    begin = (np.cumsum(lengths) - lengths)[which]
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(begin - (ends - counts), counts)
    return flat[at], ends
