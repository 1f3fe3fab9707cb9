"""Masked pseudo-likelihood: a small network predicts every word of a text from the words on both sides.

Words are hashed to 32,768 codes, each a path of three digits through a tree of 32 branches a level. The network adds
up one table row per neighbour (two to the left, two to the right; neighbours are told apart by 4,096 of the codes'
values), squashes the sum and predicts the word's digits one after another, each from the hidden state and the digits
before it. So every word has a probability that sums to one over all codes, given its neighbours and not itself; the
sum of their logarithms scores the text.

Training starts from the code frequencies of the whole corpus and runs in numpy inside Spark tasks. Every document goes
by a hash of its key and text to a block; there are more blocks the more words there are, a task trains a block in the order
of the hashes, and the states of a round's blocks are averaged as whole numbers. So neither the files nor the tasks
that a corpus happens to be cut into change a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.llm.common import as_bytes, parts, spread_out
from folioworks.session import materialise

BITS, LEVELS = 5, 3
BRANCHES, CODES = 1 << BITS, 1 << BITS * LEVELS
NEAR = 4096
HIDDEN = 16
SIDES = (-2, -1, 1, 2)
EDGE = NEAR  # the row of a neighbour beyond the text
SLICE_BYTES = 2 << 20
BATCH = 2048
RATE = 0.05
ROUNDS = 4
BLOCK_WORDS = 4_000_000
CHUNK = 1 << 18
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd numbers; any would do
SAFE = 60.0
LEVEL_ONES = np.repeat(np.eye(LEVELS, dtype=np.float32), BRANCHES, axis=0)
UNIT = float(1 << 20)  # averaged states are sums of whole multiples of 1 / UNIT, which do not depend on their order
SHAPES = {
    "side": (len(SIDES), NEAR + 1, HIDDEN),
    "out": (HIDDEN, LEVELS * BRANCHES),
    "given0": (1, BRANCHES),
    "given1": (BRANCHES, BRANCHES),
    "given2": (BRANCHES**2, BRANCHES),
}
CODED = "_key {}, _h bigint, _codes binary, _n bigint"


def _values() -> np.ndarray:
    """What each byte counts for in a word's hash: white space 0, capitals as small letters."""
    values = np.arange(256)
    values[65:91] += 32
    values += 1
    values[[32, *range(9, 14)]] = 0
    return values.astype(np.uint8)  # UTF-8 has no byte 255


VALUES = _values()


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash's base and of its inverse, modulo 2^64."""
    made = np.ones((2, size), np.uint64)
    made[:, 1:] = np.array([[BASE], [pow(BASE, -1, 1 << 64)]], np.uint64)
    up, down = np.cumprod(made, axis=1)
    return up, down


def _word_codes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Codes of the words that start at ``starts``, from a polynomial over each word's bytes. A range of about ``CHUNK`` bytes is
    worked on at a time; a longer word is a range of its own."""
    made, low = np.empty(len(starts), np.int16), 0
    while low < len(starts):
        at = starts[low]
        high = len(starts) if len(values) - at <= CHUNK else max(low + 1, int(np.searchsorted(starts, at + CHUNK, side="right")) - 1)
        part = values[at : starts[high] if high < len(starts) else len(values)]
        up, down = _powers(max(CHUNK, 1 << (len(part) - 1).bit_length()))
        places = starts[low:high] - at
        hashed = np.add.reduceat(part * up[: len(part)], places) * down[places]  # white space adds nothing
        hashed ^= hashed >> np.uint64(29)
        made[low:high] = (hashed * np.uint64(MIX)) >> np.uint64(64 - BITS * LEVELS)
        low = high
    return made


class Network:
    def __init__(self, state: np.ndarray):
        at = 0
        self.state = state
        for name, shape in SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, state[at : at + n].reshape(shape))
            at += n

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 7) -> Network:
        """A network that knows how often each code occurs and nothing about neighbours yet."""
        rng = np.random.default_rng(seed)
        net = cls(np.zeros(sum(int(np.prod(s)) for s in SHAPES.values()), np.float32))
        net.side[:] = rng.normal(0, 0.1, net.side.shape)
        net.out[:] = rng.normal(0, 0.1, net.out.shape)
        table = counts + 0.1
        for level in reversed(range(LEVELS)):
            table = table.reshape(BRANCHES**level, BRANCHES)
            total = table.sum(axis=1)
            getattr(net, f"given{level}")[:] = np.log(table / total[:, None])
            table = total
        return net

    def _logits(self, around: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden states, and by level what speaks for each digit, within what an exponential can hold."""
        summed = self.side[0].take(around[0], axis=0)
        for j in range(1, len(SIDES)):
            summed += self.side[j].take(around[j], axis=0)
        hidden = np.tanh(summed, out=summed)
        logits = (hidden @ self.out).reshape(len(codes), LEVELS, BRANCHES)
        for level in range(LEVELS):
            logits[:, level] += getattr(self, f"given{level}").take(above(codes, level), axis=0)
        if logits.max() > SAFE or logits.min() < -SAFE:
            logits -= logits.max(axis=2, keepdims=True)
        return hidden, logits

    def forward(self, around: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Log-probability of each code given its neighbours."""
        _, logits = self._logits(around, codes)
        told = np.take_along_axis(logits, digits(codes)[:, :, None], axis=2)[:, :, 0].sum(axis=1)
        return told - np.log(_level_sums(np.exp(logits, out=logits))).sum(axis=1)

    def learn(self, around: np.ndarray, codes: np.ndarray, rate: float, seen: Network) -> None:
        """One step down the mean loss of a batch. ``seen`` adds up squared gradients, by which every parameter's steps
        are scaled, so that rare neighbours learn as fast as common ones."""
        n = len(codes)
        hidden, d = self._logits(around, codes)
        np.exp(d, out=d)  # softmax less the right answer
        d *= (1 / (n * _level_sums(d)))[:, :, None]
        d[np.arange(n)[:, None], np.arange(LEVELS), digits(codes)] -= 1 / n
        flat = d.reshape(n, LEVELS * BRANCHES)
        d_hidden = (flat @ self.out.T) * (1 - hidden * hidden)

        def move(name: str, at, gradient: np.ndarray) -> None:
            squares = getattr(seen, name)
            total = squares[at] + gradient * gradient
            squares[at] = total
            getattr(self, name)[at] -= rate * gradient / np.sqrt(total + 1e-10)

        move("out", slice(None), hidden.T @ flat)
        move("given0", 0, d[:, 0].sum(axis=0))
        for level in range(1, LEVELS):
            of, sums = _summed(above(codes, level), d[:, level])
            move(f"given{level}", of, sums)
        for j in range(len(SIDES)):
            of, sums = _summed(around[j], d_hidden)
            move("side", (j, of), sums)


def _level_sums(values: np.ndarray) -> np.ndarray:
    """Sums over the digits of each level, as a product, which is quicker than a sum over short rows."""
    return values.reshape(len(values), -1) @ LEVEL_ONES


def above(codes: np.ndarray, level: int) -> np.ndarray:
    """The digits of codes before ``level``, as one number."""
    return codes >> BITS * (LEVELS - level)


def digits(codes: np.ndarray) -> np.ndarray:
    """The digit of each code at each level."""
    return np.stack([above(codes, level + 1) & BRANCHES - 1 for level in range(LEVELS)], axis=1)


def _summed(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of the rows of each."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order], prepend=-1))
    return keys[order][cuts], np.add.reduceat(rows[order], cuts)


def coded(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words, and the number of words of each text. Words lie between ASCII white space; capitals of ASCII do not count."""
    texts = [t or b"" for t in texts]
    values = VALUES[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    inside = values != 0
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    # Short integers: numpy sorts them by their digits.
    return _word_codes(values, starts), counts


def neighbours(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """By side, what stands beside each word: EDGE beyond its text."""
    owner, place = spread_out(counts)
    near, around = flat % NEAR, np.full((len(SIDES), len(flat)), EDGE, np.int16)
    for j, side in enumerate(SIDES):
        inside = (place + side >= 0) & (place + side < counts[owner])
        around[j, inside] = near[np.flatnonzero(inside) + side]
    return around


def code_table(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key, _h, _codes, _n``: every text once as the codes of its words, two bytes each, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in parts(batch, "_text", SLICE_BYTES):
                flat, counts = coded(as_bytes(piece.column("_text")))
                raw, ends = flat.tobytes(), 2 * np.cumsum(counts)
                packed = [raw[e - 2 * n : e] for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.record_batch({"_key": piece.column("_key"), "_h": piece.column("_h"), "_codes": pa.array(packed, pa.binary()), "_n": counts})

    source = documents.select(
        documents[key].alias("_key"), F.xxhash64(documents[key], documents[text]).alias("_h"), documents[text].alias("_text")
    )
    kind = documents.schema[key].dataType.simpleString()
    return materialise(source.mapInArrow(run, CODED.format(kind)), "word-codes")


def _unpacked(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(as_bytes(piece.column("_codes"))), np.int16), piece.column("_n").to_numpy()


def frequencies(table: DataFrame) -> np.ndarray:
    """How often each code occurs in all rows of a code table."""
    counts = np.zeros(CODES)
    got = table.select("_codes").mapInArrow(_counter, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts[got["code"].to_numpy()] = got["n"].to_numpy()
    return counts


def train(documents: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = ROUNDS, rate: float = RATE, seed: int = 7) -> np.ndarray:
    """State of a network trained on every word of every document once; see :func:`train_on`."""
    return train_on(code_table(documents, key, text), rounds, rate, seed)


def train_on(table: DataFrame, rounds: int = ROUNDS, rate: float = RATE, seed: int = 7, block_words: int = BLOCK_WORDS) -> np.ndarray:
    """State of a network trained on the rows of a code table.

    Rows that agree in key and text count in the frequencies and are trained on once. A round trains its share of
    the blocks from the common state, one after another within a task, and averages their states by their numbers of
    words. What a task sends is one row per parameter; the driver gets the averages, whose number is fixed by the network
    (about three hundred thousand). An empty corpus leaves the start.
    """
    counts = frequencies(table)
    state = Network.start(counts, seed).state
    blocks = max(rounds, -(-int(counts.sum()) // block_words))
    own = table.where("_n > 0").select("_h", "_codes", "_n").distinct().withColumn("_block", F.pmod("_h", F.lit(blocks)))
    dealt = materialise(own, "dealt-codes") if blocks > rounds else own
    for number in range(rounds if counts.any() else 0):
        turn = dealt.where(F.col("_block") % rounds == number).repartition("_block").sortWithinPartitions("_block", "_h", "_codes")
        sums = turn.select("_block", "_codes", "_n").mapInArrow(_trainer(state, rate), "at int, value bigint, words bigint")
        means = sums.groupBy("at").agg((F.sum(F.col("value").cast("decimal(20,0)")).cast("double") / F.sum("words")).alias("value"))
        got = materialise(means, "network").toArrow()
        if got.num_rows:
            state = np.empty_like(state)
            state[got["at"].to_numpy()] = got["value"].to_numpy() / UNIT
    return state


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CODES, np.int64)
    for batch in batches:
        for piece in parts(batch, "_codes", SLICE_BYTES):
            counts += np.bincount(np.frombuffer(b"".join(as_bytes(piece.column("_codes"))), np.int16), minlength=CODES)
    found = np.flatnonzero(counts)
    yield pa.record_batch({"code": found.astype(np.int32), "n": counts[found]})


class Learner:
    """Trains a block: whatever pieces its words come in, steps are of ``BATCH`` words."""

    def __init__(self, state: np.ndarray, rate: float):
        self.net, self.squares, self.rate, self.words = Network(state.copy()), Network(np.zeros_like(state)), rate, 0
        self.flat, self.around = np.zeros(0, np.int16), np.zeros((len(SIDES), 0), np.int16)

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat])
        self.around = np.concatenate([self.around, neighbours(flat, counts)], axis=1)
        self._step(len(self.flat) // BATCH * BATCH)

    def _step(self, stop: int) -> None:
        for low in range(0, stop, BATCH):
            high = min(low + BATCH, stop)
            self.net.learn(self.around[:, low:high], self.flat[low:high], self.rate, self.squares)
        self.words += stop
        self.flat, self.around = self.flat[stop:], self.around[:, stop:]

    def done(self) -> tuple[np.ndarray, int]:
        """The state in whole units, times the number of words, and that number."""
        self._step(len(self.flat))
        return np.rint(self.net.state.astype(np.float64) * UNIT).astype(np.int64) * self.words, self.words


def _trainer(state: np.ndarray, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words, block, learner = np.zeros(len(state), np.int64), 0, None, None
        for batch in batches:
            for piece in parts(batch, "_codes", SLICE_BYTES):
                of = piece.column("_block").to_numpy()
                cuts = [*np.flatnonzero(np.diff(of, prepend=of[0] - 1)).tolist(), len(of)]
                for low, high in zip(cuts, cuts[1:]):
                    if of[low] != block:
                        if learner:
                            add, n = learner.done()
                            total, words = total + add, words + n
                        block, learner = of[low], Learner(state, rate)
                    learner.add(*_unpacked(piece.slice(low, high - low)))
        if learner:
            add, n = learner.done()
            total, words = total + add, words + n
            yield pa.record_batch({"at": np.arange(len(total), dtype=np.int32), "value": total, "words": np.full(len(total), words, np.int64)})

    return run


def score_table(table: DataFrame, state: np.ndarray, key: str = "doc_id") -> DataFrame:
    """``key, n_tokens, log_likelihood, mean_log_likelihood`` per row of a code table; no words: 0, 0.0 and null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(state.copy())
        for batch in batches:
            for piece in parts(batch, "_codes", SLICE_BYTES):
                flat, counts = _unpacked(piece)
                around, logs = neighbours(flat, counts), np.zeros(len(flat))
                for low in range(0, len(flat), BATCH):
                    logs[low : low + BATCH] = net.forward(around[:, low : low + BATCH], flat[low : low + BATCH])
                sums = np.concatenate([[0.0], np.cumsum(logs)])
                ends = np.cumsum(counts)
                total = np.where(counts > 0, np.round(sums[ends] - sums[ends - counts], 4), 0.0)
                mean = np.round(total / np.maximum(counts, 1), 6)
                yield pa.record_batch({
                    key: piece.column("_key"), "n_tokens": counts, "log_likelihood": total,
                    "mean_log_likelihood": pa.array(mean, mask=counts == 0),
                })

    kind = table.schema["_key"].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, log_likelihood double, mean_log_likelihood double"
    return table.select("_key", "_codes", "_n").mapInArrow(run, schema)


def pseudo_likelihood(documents: DataFrame, state: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of ``documents`` under a trained state, as :func:`score_table` gives them."""
    return score_table(code_table(documents, key, text), state, key)


def score_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Train on ``documents`` and score each of their rows.

    One row per input row, repeated rows included; a null or empty text has no tokens, log-likelihood 0 and no mean. A
    null key is passed on. Of an empty table there are no rows. Other columns are not read.
    """
    table = code_table(documents, key, text)
    return score_table(table, train_on(table, rounds), key)
