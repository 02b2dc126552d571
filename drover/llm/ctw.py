"""Language model by context-tree weighting over the bits of bytes, trained and applied in Spark.

A text is scored as its token sequence: lower-cased words with one blank
between them and one end after the last. Every byte is eight binary choices.
For each choice and each context of 0 to DEPTH bytes before it there is a
Krichevsky-Trofimov estimate from the training counts; the estimates of all
depths are mixed with the weights of context-tree weighting: half for stopping
at a context, half for its longer contexts, by how well either predicts the
training data. A context that was never seen doesn't take part.

Nothing that grows with the corpus is broadcast. Texts are cut into blocks; each
block asks for the strings of DEPTH + 1 bytes and the words it has, counts meet
by string in a shuffle, subtrees of the context tree are weighted in groups of
two context bytes, and each block gets back the values it asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.llm.text import Words, runs, tidy, utf8
from drover.session import shared_path

DEPTH = 5
#: Text bytes of a block, which one task holds with the values of its strings.
BLOCK_BYTES = 24 << 20

_WORD = np.uint64(1 << 63)
#: Stands for the end among the words.
END = np.uint64(2**64 - 1)
_NODES = 256


def sequences(words: Words, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Text index of every byte of the token sequences, and its string: context and byte as a number.

    The latest context byte comes first in the number and the byte itself last.
    Before a text stand ends.
    """
    size = words.end - words.start
    ends = np.cumsum(words.counts)
    last = np.zeros(len(size), dtype=bool)
    last[ends[words.counts > 0] - 1] = True
    total = np.bincount(words.text, weights=size + 1, minlength=texts).astype(np.int64)
    total[total == 0] = 1
    begin = np.cumsum(total + DEPTH) - total
    first_word = ends - words.counts
    at = np.cumsum(size + 1) - (size + 1)
    base = np.zeros(texts, dtype=np.int64)
    base[words.counts > 0] = at[first_word[words.counts > 0]]
    place = begin[words.text] + at - base[words.text]
    out = np.full(int(begin[-1] + total[-1]) if texts else 0, 10, dtype=np.uint8)
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(place, size) + step] = words.data[np.repeat(words.start, size) + step]
    out[(place + size)[~last]] = 32
    owner = np.repeat(np.arange(texts), total)
    scored = np.repeat(begin - (np.cumsum(total) - total), total) + np.arange(total.sum())
    code = out[scored].astype(np.uint64)
    for k in range(1, DEPTH + 1):
        code |= out[scored - k].astype(np.uint64) << np.uint64(8 * (DEPTH - k + 1))
    return owner, code


def _blocks(docs: DataFrame) -> DataFrame:
    """Texts stored in the shared folder, compressed, with their block and whether they are held out."""
    names = ["block", "doc_id", "held_out", "packed"]

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, size = zstandard.ZstdCompressor(level=1), 0
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            view = memoryview(np.ascontiguousarray(data))
            packed = [press.compress(view[a:b]) for a, b in zip(offsets, offsets[1:])]
            number = (size + offsets[:-1]) // BLOCK_BYTES
            size += int(offsets[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(number.astype(np.int64)), batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                names,
            )

    path = shared_path(docs.sparkSession, "ctw-blocks")
    cuts = docs.select("doc_id", "held_out", "text").mapInArrow(
        cut, "block long, doc_id long, held_out boolean, packed binary"
    )
    # A task's number and the count of its blocks so far name a block.
    cuts.withColumn("block", F.spark_partition_id() + F.col("block") * 2**32).write.parquet(path)
    return docs.sparkSession.read.schema(cuts.schema).parquet(path)


def _lots(packed: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about 1 MB, of which one is unpacked at a time."""
    unpress = zstandard.ZstdDecompressor()
    first, parts, size = 0, [], 0
    for row, text in enumerate(packed):
        parts.append(unpress.decompress(text.as_buffer()))
        size += len(parts[-1])
        if size >= 1 << 20 or row + 1 == len(packed):
            offsets = np.cumsum([0, *map(len, parts)])
            yield first, row + 1, np.frombuffer(b"".join(parts), dtype=np.uint8), offsets
            first, parts, size = row + 1, [], 0


def _tally(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = runs(key)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _asked(blocks: DataFrame) -> DataFrame:
    """(block, key, count): strings and words of each block, with their counts in its training texts."""

    @tidy
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, counts = None, [], []

        def flush() -> pa.RecordBatch:
            key, count = _tally(keys, counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), current)), pa.array(key.view(np.int64)), pa.array(count)],
                ["block", "key", "count"],
            )

        for batch in batches:
            block = batch.column(0).to_numpy()
            for low in runs(block):
                high = low + int((block[low:] == block[low]).sum())
                if current is not None and current != block[low]:
                    yield flush()
                    keys, counts = [], []
                current = int(block[low])
                held = batch.column(2).slice(low, high - low).to_numpy(zero_copy_only=False)
                for at, end, data, offsets in _lots(batch.column(3).slice(low, high - low)):
                    words = Words(data, offsets)
                    owner, code = sequences(words, end - at)
                    out = held[at:end]
                    for key, text in ((code, owner), (words.hash | _WORD, words.text)):
                        for chosen, value in ((~out[text], 1), (out[text], 0)):
                            key_, count = np.unique(key[chosen], return_counts=True)
                            keys.append(key_)
                            counts.append(count * value)
                    keys.append(np.array([END]))
                    counts.append(np.array([int((~out).sum())]))
                    waiting = sum(map(len, keys[1:]))
                    if waiting > 1 << 20:
                        key, count = _tally(keys, counts)
                        keys, counts = [key], [count]
        if current is not None:
            yield flush()

    return blocks.mapInArrow(listed, "block long, key long, count long")


def _log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log(gamma(n + 1/2) / gamma(1/2)) of whole numbers."""
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(64) + 0.5))])
    x = np.maximum(n, 1) + 0.5
    series = (x - 0.5) * np.log(x) - x + 0.5 * log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n < 64, small[np.minimum(n, 64).astype(np.int64)], series - 0.5 * log(np.pi))


def _log_factorial(n: np.ndarray) -> np.ndarray:
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 65)))])
    x = np.maximum(n, 1) + 1.0
    series = (x - 0.5) * np.log(x) - x + 0.5 * log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n < 64, small[np.minimum(n, 64).astype(np.int64)], series)


def kt_log_probability(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma_half(zeros) + _log_gamma_half(ones) - _log_factorial(zeros + ones)


class Level:
    """All binary nodes of one depth within a subtree.

    `unit` holds the distinct (context, byte) and `nodes[k]` the node of each
    where k bits of the byte are known; a node has counts, KT and weighted logs.
    """

    def __init__(self, depth: int, code: np.ndarray, count: np.ndarray):
        cut = np.uint64(8 * (DEPTH - depth + 1))
        packed = ((code >> cut) << np.uint64(8)) | (code & np.uint64(255))
        self.unit, self.row = np.unique(packed, return_inverse=True)
        held = np.bincount(self.row, weights=count, minlength=len(self.unit))
        self.nodes, self.zeros, self.ones, self.kt = [], [], [], []
        for k in range(8):
            above = self.unit >> np.uint64(8 - k)
            first = runs(above)
            bit = ((self.unit >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
            node = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(above))))
            zeros = np.add.reduceat(np.where(bit, 0, held), first)
            ones = np.add.reduceat(np.where(bit, held, 0), first)
            self.nodes.append(node)
            self.zeros.append(zeros)
            self.ones.append(ones)
            self.kt.append(kt_log_probability(zeros, ones))
        self.weighted = [kt.copy() for kt in self.kt]

    def weigh(self, deeper: Level) -> None:
        """Half the estimate of this depth, half the product of the longer contexts."""
        parent = ((deeper.unit >> np.uint64(16)) << np.uint64(8)) | (deeper.unit & np.uint64(255))
        place = np.searchsorted(self.unit, parent)
        for k in range(8):
            first = runs(deeper.nodes[k])
            product = np.bincount(
                self.nodes[k][place[first]], weights=deeper.weighted[k], minlength=len(self.kt[k])
            )
            self.weighted[k] = np.logaddexp(self.kt[k], product) - log(2)


def subtree(code: np.ndarray, count: np.ndarray, top: int) -> list[Level]:
    """Levels `top` to DEPTH over the strings, weighted from the deepest up."""
    levels = [Level(depth, code, count) for depth in range(top, DEPTH + 1)]
    for upper, lower in zip(levels[-2::-1], levels[:0:-1]):
        upper.weigh(lower)
    return levels


class Top:
    """Counts and stopping weights at depths 0 and 1, whose nodes are at most 256 + 1 times 255."""

    def __init__(self, found: pd.DataFrame):
        shape = (256, _NODES)
        self.counts = np.zeros((2, *shape))
        product = np.zeros(shape)
        byte, node = found["byte"].to_numpy(dtype=np.int64), found["node"].to_numpy(dtype=np.int64)
        self.counts[0][byte, node] = found["zeros"]
        self.counts[1][byte, node] = found["ones"]
        product[byte, node] = found["weighted"]
        kt = kt_log_probability(*self.counts)
        weighted = np.logaddexp(kt, product) - log(2)
        self.stop = np.exp(kt - log(2) - weighted)
        self.root = self.counts.sum(axis=1)
        kt = kt_log_probability(*self.root)
        self.root_stop = np.exp(kt - log(2) - (np.logaddexp(kt, weighted.sum(axis=0)) - log(2)))


def log_probabilities(code: np.ndarray, count: np.ndarray, top: Top) -> np.ndarray:
    """log10 of the mixed probability of each string's last byte after its context."""
    levels = subtree(code, count, 2)
    recent = (code >> np.uint64(8 * DEPTH)).astype(np.int64)
    byte = (code & np.uint64(255)).astype(np.int64)
    total = np.zeros(len(code))
    for k in range(8):
        node = (1 << k) | (byte >> (8 - k))
        bit = (byte >> (7 - k)) & 1
        mixed, seen = np.zeros(len(code)), np.zeros(len(code), dtype=bool)
        steps = []
        for level in levels:
            place = level.nodes[k][level.row]
            stop = np.exp(level.kt[k] - log(2) - level.weighted[k])[place]
            steps.append((level.zeros[k][place], level.ones[k][place], stop))
        steps.insert(0, (top.counts[0][recent, node], top.counts[1][recent, node], top.stop[recent, node]))
        steps.insert(0, (top.root[0][node], top.root[1][node], top.root_stop[node]))
        for zeros, ones, stop in reversed(steps):
            estimate = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
            here = np.where(seen, stop * estimate + (1 - stop) * mixed, estimate)
            present = zeros + ones > 0
            mixed = np.where(present, here, mixed)
            seen |= present
        total += np.log10(np.where(seen, mixed, 0.5))
    return total


class Lookup:
    """Values by 64-bit key; keys are spread over slots, each with the few keys that fall there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(int(len(keys)).bit_length() + 1, 4))
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        self.keys = np.append(keys[order], np.uint64(0))
        self.values = np.append(values[order], 0.0)
        count = np.bincount(slot, minlength=1 << (64 - int(self.shift)))
        self.end = np.cumsum(count)
        self.first = self.end - count

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that are all there."""
        slot = self._slot(keys)
        place = self.first[slot]
        wrong = np.flatnonzero(self.keys[place] != keys)
        while len(wrong):
            place[wrong] += 1
            wrong = wrong[self.keys[place[wrong]] != keys[wrong]]
        return self.values[place]


def score(docs: DataFrame) -> DataFrame:
    """Train on rows that aren't `held_out` and score all rows of `docs` (doc_id, text, held_out).

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    and bits_per_byte (code length per byte of the token sequence). Tokens are
    lower-cased words and one end. `base_score` is the add-0.1 unigram model
    over the training tokens. NULL and empty texts are the end alone. Without
    training texts every bit has probability one half. Repeated rows are scored
    each; NULL ids are kept; a NULL `held_out` counts as held out; an empty table gives an empty one.
    """
    unseen = F.coalesce("held_out", F.lit(True)).alias("held_out")
    blocks = _blocks(docs.select(F.col("doc_id").cast("long"), "text", unseen))
    spark = docs.sparkSession
    path = shared_path(spark, "ctw-counts")
    asked = _asked(blocks)
    asked.groupBy("key").agg(F.sum("count").alias("count"), F.collect_list("block").alias("blocks")).write.parquet(path)
    counts = spark.read.parquet(path)

    tokens = counts.where("key < 0").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count(F.when(F.col("count") > 0, 1)).alias("v")
    ).first()
    train_tokens, distinct = tokens["n"], tokens["v"]

    strings = counts.where("key >= 0").select("key", "count")
    recent = F.shiftright("key", 8 * (DEPTH - 1))

    def arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(table.column("key").to_numpy())
        return (
            table.column("key").to_numpy()[order].view(np.uint64),
            table.column("count").to_numpy()[order].astype(np.float64),
        )

    @tidy
    def summits(table: pa.Table) -> pa.Table:
        code, count = arrays(table)
        level = subtree(code, count, 2)[0]
        parts = []
        for k in range(8):
            first = runs(level.nodes[k])
            unit = level.unit[first]
            parts.append(
                pa.table(
                    {
                        "byte": ((unit >> np.uint64(16)) & np.uint64(255)).astype(np.int32),
                        "node": ((1 << k) | ((unit & np.uint64(255)) >> np.uint64(8 - k)).astype(np.int32)).astype(np.int32),
                        "zeros": level.zeros[k],
                        "ones": level.ones[k],
                        "weighted": level.weighted[k],
                    }
                )
            )
        return pa.concat_tables(parts)

    grouped = strings.withColumn("recent", recent).groupBy("recent")
    top = Top(
        grouped.applyInArrow(summits, "byte int, node int, zeros double, ones double, weighted double")
        .groupBy("byte", "node")
        .agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")))
        .toPandas()  # at most 256 * 255 rows
    )
    state = spark.sparkContext.broadcast(top)

    @tidy
    def priced(table: pa.Table) -> pa.Table:
        code, count = arrays(table)
        return pa.table({"key": code.view(np.int64), "value": log_probabilities(code, count, state.value)})

    prices = grouped.applyInArrow(priced, "key long, value double")
    wanted = counts.where("key >= 0").select("key", "blocks").join(prices, "key")
    wanted = wanted.select("key", "value", F.explode("blocks").alias("block")).unionByName(
        counts.where("key < 0").select(
            "key", F.col("count").cast("double").alias("value"), F.explode("blocks").alias("block")
        )
    )

    floor = np.log10(train_tokens + 0.1 * (distinct + 1))
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double"
    )

    @tidy
    def judged(texts: pa.Table, values: pa.Table) -> pa.Table:
        key, first = np.unique(values.column("key").to_numpy().view(np.uint64), return_index=True)
        value = values.column("value").to_numpy()[first]
        split = int(np.searchsorted(key, _WORD))
        strings, words_ = Lookup(key[:split], value[:split]), Lookup(key[split:], value[split:])
        end = words_(np.array([END]))[0]
        found = []
        packed = texts.column("packed").combine_chunks()
        for first_row, end_row, data, offsets in _lots(packed):
            many = end_row - first_row
            words = Words(data, offsets)
            owner, code = sequences(words, many)
            size = np.bincount(owner, minlength=many)
            total = np.bincount(owner, weights=strings(code), minlength=many)
            times = words_(words.hash | _WORD)
            base = np.bincount(words.text, weights=np.log10(times + 0.1) - floor, minlength=many)
            known = np.bincount(words.text, weights=times > 0, minlength=many) + (end > 0)
            found.append((words.counts + 1, known, base + np.log10(end + 0.1) - floor, total, -total / np.log10(2) / size))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "n_tokens": columns[0].astype(np.int64),
                "n_known": columns[1].astype(np.int64),
                "train_tokens": np.full(texts.num_rows, train_tokens, dtype=np.int64),
                "base_score": columns[2],
                "score": columns[3],
                "bits_per_byte": columns[4],
            }
        )

    return blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(judged, schema)
