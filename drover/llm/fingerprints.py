"""I-Match fingerprints: hashes of the mid-frequency terms, over several randomised lexicon subsets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from drover.llm.text import Words, lots, mix, runs, tidy, utf8
from drover.session import stage

#: Band of document frequency, as parts of all documents. In a corpus with D distinct words in
#: a text on average, at most D / LEAST_PART words can be that frequent, whatever its size.
LEAST_PART = 0.001
MOST_PART = 0.1
#: Lexicon subsets: at level l a subset holds one term in 2 ** l.
LEVELS = 12
SUBSETS = 16
DIGITS = 2
#: Levels whose subsets hold one term in SUBSETS or less. At these all words are hashed too, dealt to
#: subsets that share no word, and at these fingerprints are compared.
SPARSE = SUBSETS.bit_length() - 1
WIDTH = (2 * LEVELS - SPARSE) * SUBSETS

_SALTS = np.random.default_rng(41).integers(1, 2**63, SUBSETS + 1, dtype=np.uint64)


def distinct_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text index and hash of each text's distinct words, sorted by both."""
    words = Words(data, offsets)
    order = np.lexsort((words.hash, words.text))
    owner, term = words.text[order], words.hash[order]
    keep = np.ones(len(owner), dtype=bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])
    return owner[keep], term[keep]


def lexicon(docs: DataFrame, least_part: float = LEAST_PART, most_part: float = MOST_PART) -> np.ndarray:
    """Sorted hashes of the words whose document frequency lies in the band, over all texts.

    NULL and empty texts count as documents without words. Tasks count their own
    texts first; only the words in the band reach the driver.
    """

    @tidy
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [np.zeros(0, dtype=np.uint64)], 0

        def tally() -> pa.RecordBatch:
            term, count = np.unique(np.concatenate(found), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(term.view(np.int64)), pa.array(count.astype(np.int32))], ["term", "docs"]
            )

        for batch in batches:
            for _, _, data, offsets in lots(batch.column(0)):
                found.append(distinct_terms(data, offsets)[1])
                size += len(found[-1])
                if size > 1 << 21:
                    yield tally()
                    found, size = [np.zeros(0, dtype=np.uint64)], 0
        yield tally()

    total = docs.count()
    least, most = max(1, math.ceil(least_part * total)), math.floor(most_part * total)
    found = (
        docs.select("text")
        .mapInArrow(counted, "term long, docs int")
        .groupBy("term")
        .agg(F.sum("docs").alias("docs"))
        .where(F.col("docs").between(least, most))
        .select("term")
        .toArrow()
    )
    return np.sort(found.column("term").to_numpy().view(np.uint64))


def _digest(drawn: np.ndarray, first: np.ndarray) -> np.ndarray:
    """1 to 255 for each run of drawn terms."""
    modulus = np.uint64(16**DIGITS - 1)
    return mix(np.add.reduceat(mix(drawn), first)) % modulus + np.uint64(1)


def imatch(texts: pa.Array, band: np.ndarray) -> np.ndarray:
    """Fingerprints as a table of bytes: a row for each text, WIDTH columns.

    The distinct terms inside the band are sorted and hashed for every level and
    lexicon subset; 0 stands for a subset without a term of the text. Then, for
    every text alike, all its distinct words are hashed at the sparse levels, so
    that texts which share the few words that they have in the band differ.
    """
    parts = [np.zeros((0, WIDTH), dtype=np.uint8)]
    for at, end, data, offsets in lots(texts):
        owner, term = distinct_terms(data, offsets)
        table = np.zeros((end - at, WIDTH), dtype=np.uint8)
        drawn = mix(term ^ _SALTS[SUBSETS])
        cell = owner * SUBSETS + (drawn % np.uint64(SUBSETS)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        drawn, cell = drawn[order], cell[order]
        for level in range(SPARSE, LEVELS):
            if level > SPARSE:
                chosen = (drawn & np.uint64(1 << (level - 1))) == 0
                drawn, cell = drawn[chosen], cell[chosen]
            first = runs(cell)
            if not len(first):
                break
            row, subset = np.divmod(cell[first], SUBSETS)
            table[row, (LEVELS + level - SPARSE) * SUBSETS + subset] = _digest(drawn, first)
        inside = np.zeros(len(term), dtype=bool)
        if len(band):
            place = np.minimum(np.searchsorted(band, term), len(band) - 1)
            inside = band[place] == term
        owner, term = owner[inside], term[inside]
        for k, salt in enumerate(_SALTS[:SUBSETS]):
            drawn, who = mix(term ^ salt), owner
            for level in range(LEVELS):
                if level:  # one more zero bit: half of the terms stay
                    chosen = (drawn & np.uint64(1 << (level - 1))) == 0
                    drawn, who = drawn[chosen], who[chosen]
                first = runs(who)
                if not len(first):
                    break
                table[who[first], level * SUBSETS + k] = _digest(drawn, first)
        parts.append(table)
    return np.concatenate(parts)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Part of the lexicon subsets on which fingerprints agree, 0 to 1, row by row.

    Both for the band and for all words, subsets are compared at the sparsest
    level where half of them have a term of either text: subsets with about one
    term each survive small edits. Where no level has that many, the first
    sparse one is taken, whose subsets number about as many as the terms; so a
    band with few terms of the two texts says little. Equal fingerprints have
    likeness 1, also empty ones.
    """
    held = np.zeros(len(a), dtype=np.int64)
    same = np.zeros(len(a), dtype=np.int64)
    shape = (len(a), LEVELS - SPARSE, SUBSETS)
    for begin in (SPARSE * SUBSETS, LEVELS * SUBSETS):
        x, y = (t[:, begin : begin + shape[1] * SUBSETS].reshape(shape) for t in (a, b))
        some = (x | y) != 0
        filled = some.sum(axis=2)
        enough = 2 * filled >= SUBSETS
        level = np.where(enough.any(axis=1), shape[1] - 1 - enough[:, ::-1].argmax(axis=1), 0)
        row = np.arange(len(a))
        held += filled[row, level]
        same += ((x == y) & some).sum(axis=2)[row, level]
    equal = (a == b).all(axis=1)
    return np.where(equal, 1.0, same / np.maximum(held, 1))


def _binary(table: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in table], pa.binary())


def fingerprint(docs: DataFrame, band: np.ndarray) -> DataFrame:
    """Adds `fingerprint` as hex digits, in place of a column of that name.

    NULL texts count as empty, whose fingerprint is all zeros. Rows with equal
    texts get equal fingerprints; an empty table gives an empty one.
    """
    docs = docs.drop("fingerprint")
    state = docs.sparkSession.sparkContext.broadcast(band)

    @tidy
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = _binary(imatch(batch.column(1), state.value))
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["row", "fingerprint"])

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    frame = docs.select(row, "text")
    kind = frame.schema["row"].dataType.simpleString()
    found = frame.mapInArrow(task, f"row {kind}, fingerprint binary")
    return found.select("row.*", _hex("fingerprint"))


def _hex(name: str) -> Column:
    return F.lower(F.hex(name)).alias(name)


EDIT_FIELDS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("task", pa.int32()),
        ("packed", pa.binary()),
    ]
)


def _compare(ids: list, texts: list[str], band: np.ndarray) -> list[tuple]:
    """A row for every text but the last, edited with the text that follows it."""
    own = imatch(pa.array(texts, pa.string()), band)
    edited = []
    for text, after in zip(texts, texts[1:]):
        part = len(text) // 4
        edited.append(text[: len(text) - part] + after[:part])
    prints = imatch(pa.array(edited, pa.string()), band)
    near_edited, near_next = likeness(own[:-1], prints), likeness(own[:-1], own[1:])
    return [
        (
            ids[k], len(texts[k]), hashlib.sha256(edited[k].encode()).hexdigest(), own[k].tobytes(),
            prints[k].tobytes(), float(near_edited[k]), float(near_next[k]),
        )
        for k in range(len(edited))
    ]


def compare_with_edits(docs: DataFrame, band: np.ndarray) -> DataFrame:
    """Fingerprints of every text and of the text with its last quarter replaced.

    The last floor(n / 4) code points give way to the first as many (or all) of
    the next document by ascending doc_id; the last document is followed by the
    first. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next (`likeness`). NULL texts are
    empty, NULL ids come first, rows with equal ids follow each other in input
    order; a single document follows itself; an empty table gives an empty one.

    Documents are dealt to ranges of doc_id, compressed on their way. A range
    compares its own neighbours; the first and last text of each range are
    stored with the results and joined afterwards, two rows for each range.
    """
    spark = docs.sparkSession
    state = spark.sparkContext.broadcast(band)
    schema = from_arrow_schema(EDIT_FIELDS)

    @tidy
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            view = memoryview(data)
            texts = [press.compress(view[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "packed"]
            )

    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(packed, "doc_id long, packed binary")
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "place")
        .sortWithinPartitions("doc_id", "place")
        .select("doc_id", "packed", F.spark_partition_id().alias("task"))
    )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), EDIT_FIELDS)]
        return pa.RecordBatch.from_arrays(columns, schema=EDIT_FIELDS)

    @tidy
    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        ids, texts, size, task, last, started = [], [], 0, None, None, False
        for batch in batches:
            for doc_id, data, task in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if not started:
                    started = True
                    yield batch_of([(doc_id, 0, *[None] * 5, task, data)])
                last = data
                ids.append(doc_id)
                texts.append(unpress.decompress(data).decode())
                size += len(data)
                if size > 1_500_000 and len(texts) > 1:
                    yield batch_of([(*r, None, None) for r in _compare(ids, texts, state.value)])
                    ids, texts, size = ids[-1:], texts[-1:], 0
        if len(texts) > 1:
            yield batch_of([(*r, None, None) for r in _compare(ids, texts, state.value)])
        if started:
            yield batch_of([(ids[-1], 1, *[None] * 5, task, last)])

    found = stage(ordered.mapInArrow(neighbours, schema), "edited")
    ends = found.where("packed IS NOT NULL")
    # Tasks in order, each with the next one that has rows: as many rows as there are ranges.
    heads = ends.where("n_chars = 0").select(F.col("task").alias("head"), F.col("packed").alias("after"))
    order = heads.selectExpr(
        "head AS task",
        "coalesce(lead(head) OVER (ORDER BY head), min(head) OVER ()) AS head",
    )
    tails = ends.where("n_chars = 1").select("doc_id", "task", "packed").join(order, "task")
    pairs = tails.join(heads, "head").select("doc_id", "packed", "after")

    @tidy
    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for doc_id, own, after in zip(*(batch.column(k).to_pylist() for k in range(3))):
                both = [unpress.decompress(x).decode() for x in (own, after)]
                yield batch_of([(*r, None, None) for r in _compare([doc_id] * 2, both, state.value)])

    whole = found.where("packed IS NULL").unionByName(pairs.mapInArrow(across, schema))
    return whole.select(
        "doc_id", "n_chars", "edited_sha256", _hex("fingerprint"), _hex("edited_fingerprint"),
        "near_edited", "near_next",
    )
