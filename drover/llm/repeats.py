"""Repeated byte strings across a corpus, from sampled suffixes of all shards merged by refinement.

A text is parsed by content: the anchor of a 200-byte window is the least
32-byte hash in it, so equal windows have equal anchors at equal places. Only
suffixes that start at anchors are sorted, about one in 85 bytes. Each is kept
with the bytes before it, as far as a window that has this anchor can start;
they take the place of the Burrows-Wheeler column.

1. Every shard (task) lists its anchors with hashes of the anchor and of its
   whole context. Anchors that occur once can't be in a repeated window. A
   context that occurs twice has all its windows repeated.
2. Where an anchor has several contexts, they are fetched once each. Blocks of
   suffixes with the same anchor are refined: each round partitions the
   interleaved suffixes of a block stably by their next symbol, and a boundary
   that appears gives the common prefix of its two neighbours. Blocks with one
   suffix take no part in later rounds.
3. Suffixes whose common prefixes reach 200 - x form an interval; those of them
   that agree in the x bytes before are repeated windows.

Anchors and contexts are compared by 64-bit hashes, suffixes byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drover.llm.keyfilter import in_filter, key_filter
from drover.llm.text import Prefix, lots, mix, runs, tidy, utf8
from drover.operators.ordering import fresh
from drover.session import stage

LENGTH = 200
ANCHOR = 32
WINDOW = LENGTH - ANCHOR + 1
#: Bytes of contexts that one task refines together.
BUCKET_BYTES = 8 << 20
#: Anchors with more contexts than this have their windows counted by hash in a shuffle instead.
LARGE_GROUP = 50_000

_PLACE = np.uint64((1 << 28) - 1)


class Anchors:
    """Anchors of several texts: `at`, first and last window start, `text`, hashes of anchor and context."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.prefix = Prefix(data)
        sizes = np.diff(offsets)
        self.key = mix(self.prefix.of(offsets[:-1], offsets[1:])).view(np.int64)
        self.sizes = sizes
        long = sizes >= LENGTH
        count = len(data) - ANCHOR + 1
        if not long.any():
            self.at = self.first = self.last = self.text = np.zeros(0, dtype=np.int64)
            self.hash = self.context = np.zeros(0, dtype=np.int64)
            return
        place = np.arange(count)
        ranked = self.prefix.of(place, place + ANCHOR)
        ranked = (ranked & ~_PLACE) | place.astype(np.uint64)
        blocks = -(-count // WINDOW)
        padded = np.full(blocks * WINDOW, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:count] = ranked
        grid = padded.reshape(blocks, WINDOW)
        before = np.minimum.accumulate(grid, axis=1).reshape(-1)
        after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        windows = count - WINDOW + 1
        least = np.minimum(after[:windows], before[WINDOW - 1 : WINDOW - 1 + windows])
        valid = np.zeros(len(data) + 1, dtype=np.int8)
        np.add.at(valid, offsets[:-1][long], 1)
        np.add.at(valid, offsets[1:][long] - LENGTH + 1, -1)
        start = np.flatnonzero(np.cumsum(valid[:windows]))
        chosen = least[start] & _PLACE
        first = runs(chosen)
        self.at = chosen[first].astype(np.int64)
        self.first = start[first]
        self.last = start[np.append(first[1:], len(start)) - 1]
        self.text = np.searchsorted(offsets, self.first, side="right") - 1
        self.hash = self.prefix.of(self.at, self.at + ANCHOR).view(np.int64)
        whole = self.prefix.of(self.first, self.last + LENGTH)
        self.context = mix(whole + (self.at - self.first).astype(np.uint64)).view(np.int64)


def _first_seen(keys: np.ndarray, seen: set) -> np.ndarray:
    fresh = np.zeros(len(keys), dtype=bool)
    for k, key in enumerate(keys.tolist()):
        if key not in seen:
            seen.add(key)
            fresh[k] = True
    return fresh


def _batch(names: list[str], *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)


def _copied(docs: DataFrame) -> DataFrame:
    """Keys of texts that occur more than once and are long enough to be removed."""

    @tidy
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in lots(batch.column(0)):
                key = mix(Prefix(data).of(offsets[:-1], offsets[1:])).view(np.int64)
                yield _batch(["key"], key[np.diff(offsets) >= LENGTH])

    found = docs.select("text").mapInArrow(keys, "key long")
    return found.groupBy("key").count().where("count > 1").select("key")


def _repeated_anchors(docs: DataFrame) -> DataFrame:
    """Hashes (key) of anchors that occur twice or more; tasks count their own first."""

    @tidy
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            hashes = [np.zeros(0, dtype=np.int64)]
            for _, _, data, offsets in lots(batch.column(0)):
                found = Anchors(data, offsets)
                hashes.append(found.hash[_first_seen(found.key, seen)[found.text]])
            yield _batch(["key", "n"], *np.unique(np.concatenate(hashes), return_counts=True))

    counts = docs.select("text").mapInArrow(tally, "key long, n long").groupBy("key")
    return counts.agg(F.sum("n").alias("n")).where("n > 1").select("key")


def _occurrences(docs: DataFrame) -> DataFrame:
    """Anchors that occur twice or more, and by chance a few others: hash, context, key, place.

    `place` holds the anchor's position and how far before it its first and last
    window start. Texts that occur more than once may be listed once for each task.
    """
    state = docs.sparkSession.sparkContext.broadcast(key_filter(_repeated_anchors(docs)))
    names = ["hash", "context", "key", "place"]

    @tidy
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for _, _, data, offsets in lots(batch.column(0)):
                found = Anchors(data, offsets)
                fresh = _first_seen(found.key, seen)[found.text] & in_filter(state.value, found.hash)
                at, text = found.at[fresh], found.text[fresh]
                place = ((at - offsets[text]) << 16) | ((at - found.first[fresh]) << 8)
                place |= at - found.last[fresh]
                yield _batch(names, found.hash[fresh], found.context[fresh], found.key[text], place)

    return docs.select("text").mapInArrow(listed, "hash long, context long, key long, place long")


def _contexts(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """The context bytes of the anchors with these hashes, once for each task that has them."""
    state = docs.sparkSession.sparkContext.broadcast(
        key_filter(hashes.select(F.col("hash").alias("key")))
    )

    @tidy
    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for _, _, data, offsets in lots(batch.column(0)):
                found = Anchors(data, offsets)
                rows = np.flatnonzero(in_filter(state.value, found.hash))
                rows = rows[_first_seen(found.context[rows], seen)]
                first, end = found.first[rows], found.last[rows] + LENGTH
                view = data.tobytes()
                yield _batch(
                    ["hash", "context", "back", "least", "bytes"],
                    found.hash[rows],
                    found.context[rows],
                    (found.at[rows] - first).astype(np.int32),
                    (found.at[rows] - found.last[rows]).astype(np.int32),
                    pa.array([view[a:b] for a, b in zip(first, end)], pa.binary()),
                )

    return docs.select("text").mapInArrow(
        fetched, "hash long, context long, back int, least int, bytes binary"
    )


def refine(block: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes (rows of equal width) in each block, and common prefixes of neighbours.

    `block` is sorted. The order inside a block is kept for equal suffixes, so
    the suffixes of a shard stay in their own order. Eight bytes are one symbol.
    """
    count, width = suffix.shape
    symbols = np.ascontiguousarray(suffix).view(">u8").astype(np.uint64)
    order = np.arange(count)
    common = np.full(count, width, dtype=np.int64)
    starts = runs(block)
    common[starts] = 0
    bounds = np.zeros(count, dtype=bool)
    bounds[starts] = True
    for round_ in range(symbols.shape[1]):
        alone = bounds & np.append(bounds[1:], True)
        active = np.flatnonzero(~alone)
        if not len(active):
            break
        group = np.cumsum(bounds)[active]
        symbol = symbols[order[active], round_]
        moved = np.lexsort((symbol, group))
        order[active] = order[active][moved]
        symbol = symbol[moved]
        split = np.flatnonzero((group[1:] == group[:-1]) & (symbol[1:] != symbol[:-1])) + 1
        unlike = symbol[split] ^ symbol[split - 1]
        same = np.zeros(len(split), dtype=np.int64)
        for byte in range(1, 8):
            same += unlike < np.uint64(1 << (64 - 8 * byte))
        common[active[split]] = round_ * 8 + same
        bounds[active[split]] = True
    return order, common


def repeated_windows(
    block: np.ndarray, back: np.ndarray, least: np.ndarray, texts: list[bytes]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of repeated windows: row, and first and last byte after it, counted from the anchor.

    Each row is an anchor's only occurrence with this context; rows are sorted by block.
    """
    count = len(texts)
    suffix = np.zeros((count, LENGTH), dtype=np.uint8)
    before = np.zeros((count, WINDOW), dtype=np.uint8)
    for k, text in enumerate(texts):
        whole = np.frombuffer(text, dtype=np.uint8)
        suffix[k, : len(whole) - back[k]] = whole[back[k] :][:LENGTH]
        before[k, : back[k]] = whole[: back[k]][::-1]
    order, common = refine(block, suffix)
    back, least, before = back[order], least[order], before[order]
    repeated = np.zeros((count, WINDOW + 1), dtype=bool)
    left = np.zeros(count, dtype=np.uint64)
    for x in range(WINDOW):
        rows = np.flatnonzero((back >= x) & (least <= x))
        interval = np.cumsum(common < LENGTH - x).astype(np.uint64)
        value = mix(interval[rows] * np.uint64(0x9E3779B97F4A7C15) + left[rows])
        by_value = np.argsort(value, kind="stable")
        ranked = value[by_value]
        twin = np.zeros(len(rows), dtype=bool)
        equal = ranked[1:] == ranked[:-1]
        twin[1:] |= equal
        twin[:-1] |= equal
        repeated[rows[by_value[twin]], x] = True
        left = mix(left + before[:, x] + np.uint64(1))
    edge = np.diff(repeated.astype(np.int8), axis=1, prepend=0)
    row, first = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return order[row], -(end - 1), LENGTH - first


def _refined(contexts: DataFrame, buckets: int) -> DataFrame:
    """(context, low, high): byte runs covered by repeated windows, counted from the anchor."""

    @tidy
    def merged(table: pa.Table) -> pa.Table:
        context = table.column("context").to_numpy()
        _, rows = np.unique(context, return_index=True)
        hashes = table.column("hash").to_numpy()[rows]
        _, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
        rows, hashes = rows[times[which] > 1], hashes[times[which] > 1]
        rows = rows[np.argsort(hashes, kind="stable")]
        texts = table.column("bytes").take(pa.array(rows)).to_pylist()
        row, low, high = repeated_windows(
            table.column("hash").to_numpy()[rows],
            table.column("back").to_numpy()[rows].astype(np.int64),
            table.column("least").to_numpy()[rows].astype(np.int64),
            texts,
        )
        return pa.table({"context": context[rows[row]], "low": low, "high": high})

    bucketed = contexts.withColumn("bucket", F.pmod(F.xxhash64("hash"), F.lit(buckets)))
    return bucketed.groupBy("bucket").applyInArrow(merged, "context long, low long, high long")


def _counted(contexts: DataFrame) -> DataFrame:
    """The same as `_refined`, by counting every window's hash; spreads one anchor over many tasks."""

    @tidy
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for context, back, least, text in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4))):
                start = np.arange(back - least + 1)
                prefix = Prefix(np.frombuffer(text, dtype=np.uint8))
                value = mix(prefix.of(start, start + LENGTH) + (back - start).astype(np.uint64))
                yield _batch(
                    ["window", "context", "x"],
                    value.view(np.int64),
                    np.full(len(start), context, dtype=np.int64),
                    back - start,
                )

    listed = contexts.mapInArrow(windows, "window long, context long, x long").distinct()
    times = F.count(F.lit(1)).over(Window.partitionBy("window"))
    twins = listed.withColumn("times", times).where("times > 1")
    return twins.selectExpr("context", "-x AS low", f"{LENGTH} - x AS high")


def find_repeats(docs: DataFrame, large_group: int = LARGE_GROUP) -> DataFrame:
    """What to remove from every distinct text: (key, copied, low, high).

    A byte is removed if a string of LENGTH bytes that covers it also starts
    elsewhere, in the same text or another; strings never cross texts. `key` is
    the text's hash. `copied` texts are removed whole, as they occur more than
    once; for the others `low` and `high` are arrays of byte runs, which may
    overlap. Texts with nothing to remove have no row; NULL counts as empty, and
    texts shorter than LENGTH bytes keep everything. An empty table gives no row.
    Places have 28 bits: in a text above 268 MB repeats can be missed.
    """
    copied = stage(_copied(docs), "repeats-copied")
    found = stage(_occurrences(docs), "repeats-anchors")
    counts = stage(found.groupBy("hash", "context").count(), "repeats-counts")
    # A context that occurs twice has only repeated windows.
    twice = counts.where("count > 1").select("hash", "context")
    resolved = found.join(twice, ["hash", "context"]).selectExpr(
        "key",
        "shiftright(place, 16) - (shiftright(place, 8) & 255) AS low",
        f"shiftright(place, 16) - (place & 255) + {LENGTH} AS high",
    )
    groups = stage(
        counts.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeats-groups"
    )
    contexts = stage(_contexts(docs, groups.select("hash")), "repeats-contexts")
    large = groups.where(F.col("n") > large_group).select("hash")
    buckets = 1 + contexts.count() * (2 * LENGTH) // BUCKET_BYTES
    if large.isEmpty():
        covered = _refined(contexts, buckets)
    else:
        covered = _refined(contexts.join(large, "hash", "left_anti").select(contexts.columns), buckets)
        covered = covered.unionByName(
            _counted(contexts.join(large, "hash", "left_semi").select(contexts.columns))
        )
    places = found.select("context", "key", F.shiftright("place", 16).alias("at"))
    partly = places.join(covered, "context").selectExpr("key", "at + low AS low", "at + high AS high")
    spans = (
        resolved.unionByName(partly)
        .join(copied, "key", "left_anti")
        .groupBy("key")
        .agg(F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))
    )
    nothing = F.array().cast("array<long>")
    whole = copied.select("key", F.lit(True).alias("copied"), nothing.alias("low"), nothing.alias("high"))
    return stage(
        whole.unionByName(spans.select("key", F.lit(False).alias("copied"), "low", "high")),
        "repeats",
    )


def united(low: list[int], high: list[int]) -> list[tuple[int, int]]:
    """Runs that don't touch, in order, which cover the same bytes."""
    out: list[list[int]] = []
    for a, b in sorted(zip(low, high)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans."""
    ends = [0, *(b for _, b in spans)]
    return b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in spans), len(text)]))


def measure(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """What the removal does to every row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Only texts that lose a part of themselves travel to their spans.
    """
    partly = repeats.where("NOT copied").select("key")
    state = docs.sparkSession.sparkContext.broadcast(key_filter(partly))
    names = ["doc_id", "n_bytes", "key", "sha", "packed"]

    @tidy
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at, end, data, offsets in lots(batch.column(1)):
                key = mix(Prefix(data).of(offsets[:-1], offsets[1:])).view(np.int64)
                view = data.tobytes()
                texts = [view[a:b] for a, b in zip(offsets, offsets[1:])]
                packed = [
                    press.compress(t) if hit else None for t, hit in zip(texts, in_filter(state.value, key))
                ]
                yield _batch(
                    names,
                    batch.column(0).slice(at, end - at),
                    np.diff(offsets),
                    key,
                    [hashlib.sha256(t).hexdigest() for t in texts],
                    pa.array(packed, pa.binary()),
                )

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, count, sha = [], [], []
            for size, digest, packed, copied, low, high in zip(
                *(batch.column(k).to_pylist() for k in (1, 2, 3, 4, 5, 6))
            ):
                spans = [(0, size)] if copied else united(low or [], high or [])
                if spans:
                    text = b"" if copied else unpress.decompress(packed) if size else b""
                    digest = hashlib.sha256(without(text, spans)).hexdigest()
                removed.append(sum(b - a for a, b in spans))
                count.append(len(spans))
                sha.append(digest)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(removed, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(sha, pa.string()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    light = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, "doc_id long, n_bytes long, key long, sha string, packed binary"
    )
    return (
        light.join(repeats, "key", "left")
        .select("doc_id", "n_bytes", "sha", "packed", "copied", "low", "high")
        .mapInArrow(
            cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        )
    )


def remove_repeats(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """The rows with repeated strings cut out of `text`, and `n_chars`, if there, counted again.

    Characters that are covered in part stay whole. Rows whose text goes
    completely stay with an empty one; a NULL text stays NULL. Rows with equal texts are
    cut alike; other columns go along whatever their names; an empty table gives an empty one.
    """
    names = docs.columns
    # Besides `text` there may be no column, but a struct has one at least.
    other = F.lit(0).alias(fresh(names, "_"))
    row = F.struct(*(F.col(f"`{c}`") for c in names if c != "text"), other).alias("row")
    frame = docs.select(row, "text")
    kind = frame.schema["row"].dataType.simpleString()

    @tidy
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                mix(Prefix(data).of(offsets[:-1], offsets[1:])).view(np.int64)
                for _, _, data, offsets in lots(batch.column(1))
            ]
            key = np.concatenate([*found, np.zeros(0, dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(key)], ["row", "text", "key"]
            )

    def inner(text: bytes, a: int, b: int) -> tuple[int, int]:
        """The run without characters that are only partly in it."""
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        return a, b

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, copied, low, high in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4))):
                if text is not None and copied:
                    text = ""
                elif text is not None and low:
                    whole = text.encode()
                    text = without(whole, [inner(whole, a, b) for a, b in united(low, high)]).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["row", "text"]
            )

    out = (
        frame.mapInArrow(keyed, f"row {kind}, text string, key long")
        .join(repeats, "key", "left")
        .select("row", "text", "copied", "low", "high")
        .mapInArrow(cut, f"row {kind}, text string")
    )
    shown = {c: F.col(f"row.`{c}`") for c in names} | {"text": F.col("text")}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        shown["n_chars"] = F.when(F.col("text").isNull(), F.col("row.n_chars")).otherwise(
            F.length("text").cast(kind)
        )
    return out.select(*(shown[c].alias(c) for c in names))
