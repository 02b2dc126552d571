"""Exact Jaccard self-join on word shingles with adaptive multi-match prefixes.

Documents with the same shingle set form a class; the join works on classes.
Shingles are ordered by how often they occur, rare ones first. Two sets that
are similar enough share at least m of the first |x| - ceil(t |x|) + m shingles
of either, for every m. A document whose prefix holds frequent shingles would
meet many others there, so it asks for a longer prefix with more matches (a
larger m), chosen by estimated cost. Only pairs with that many matches are
compared shingle by shingle.

What is wanted is which documents are connected. In a large group of near
copies all pairs would be similar, so the join first links every class to one
class per shared shingle, and after that looks only for pairs between classes
that aren't connected yet. No link between groups is lost, and links inside a
group need not be listed.

Words, shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drover.llm.components import components
from drover.llm.keyfilter import in_filter, key_filter
from drover.llm.text import Words, lots, mix, runs, shingles, tidy
from drover.operators.reconcile import match_grouped
from drover.session import stage

WORDS = 5
#: Similarity as a fraction, so that every comparison is in whole numbers.
SIMILARITY = (75, 100)
#: Largest number of prefix matches that a document may ask for.
MOST_MATCHES = 8
#: Counters of the frequency table, whose size is fixed.
COUNTERS = 1 << 23
#: Bits of the signature that every set carries.
SIGNATURE = 512
SLICES = 64


def _least_overlap(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of size n must share with any similar set: ceil(t n)."""
    return -(-n * SIMILARITY[0] // SIMILARITY[1])


def _sets(column: pa.Array) -> Iterator[tuple]:
    """Of lots of texts: first row, sizes, set keys, and the shingles with their rows."""
    for at, end, data, offsets in lots(column):
        owner, value = shingles(Words(data, offsets), end - at, WORDS)
        n = np.bincount(owner, minlength=end - at)
        first = runs(owner)
        key = np.zeros(end - at, dtype=np.uint64)
        if len(first):
            key[owner[first]] = np.add.reduceat(mix(value + np.uint64(0x51ED2701)), first)
        key = mix(key + n.astype(np.uint64)).view(np.int64)
        yield at, n, key, owner, value


def _new(keys: np.ndarray, wanted: np.ndarray, seen: set) -> np.ndarray:
    """Rows to work on: the first of each key in this task."""
    first = np.zeros(len(keys), dtype=bool)
    for k in np.flatnonzero(wanted):
        if int(keys[k]) not in seen:
            seen.add(int(keys[k]))
            first[k] = True
    return first


def survey(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, n, key, packed), and slices of counts of all shingles by hash bucket.

    `packed` is a set's signature or a slice of the counts.
    """

    @tidy
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.uint32)
        seen: set = set()

        def rows(doc_id, n, key, part, packed) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip((doc_id, n, key, part, packed), kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "key", "part", "packed"])

        for batch in batches:
            for at, n, key, owner, value in _sets(batch.column(1)):
                some = batch.slice(at, len(n))
                place = owner * SIGNATURE + (value >> np.uint64(40)).astype(np.int64) % SIGNATURE
                odd = np.bincount(place, minlength=len(n) * SIGNATURE).reshape(len(n), SIGNATURE) & 1
                signs = [x.tobytes() for x in np.packbits(odd.astype(np.uint8), axis=1)]
                yield rows(some.column(0), n, np.where(n > 0, key, 0), [None] * len(n), signs)
                first = _new(key, n > 0, seen)
                bucket = (value[first[owner]] % np.uint64(COUNTERS)).astype(np.int64)
                np.add.at(counts, bucket, 1)
        press = zstandard.ZstdCompressor(level=1)
        if seen:
            for part, piece in enumerate(counts.reshape(SLICES, -1)):
                yield rows([None], [None], [None], [part], [press.compress(piece.tobytes())])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        task, "doc_id long, n int, key long, part int, packed binary"
    )


def _frequency_levels(parts: DataFrame) -> np.ndarray:
    """Level of each hash bucket: 0 for the usual count, then one more for each factor of root 2."""

    @tidy
    def summed(table: pa.Table) -> pa.Table:
        unpress, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        total = np.zeros(COUNTERS // SLICES, dtype=np.uint32)
        for packed in table.column("packed"):
            total += np.frombuffer(unpress.decompress(packed.as_py()), dtype=np.uint32)
        return pa.table(
            {"part": table.column("part").slice(0, 1), "packed": [press.compress(total.tobytes())]}
        )

    found = (
        parts.select("part", "packed").groupBy("part").applyInArrow(summed, "part int, packed binary")
    )
    counts = np.zeros((SLICES, COUNTERS // SLICES), dtype=np.uint32)
    unpress = zstandard.ZstdDecompressor()
    for row in found.toLocalIterator():  # SLICES rows, whatever the input
        counts[row["part"]] = np.frombuffer(unpress.decompress(row["packed"]), dtype=np.uint32)
    counts = counts.reshape(-1)
    mean = counts.mean()
    usual = max(mean + 6 * np.sqrt(mean), 8.0)
    levels = np.zeros(COUNTERS, dtype=np.uint8)
    high = counts > usual
    levels[high] = 1 + np.minimum(2 * np.log2(counts[high] / usual), 60).astype(np.uint8)
    return levels


@dataclass
class Prefixes:
    """Prefix rows of sets: the set's row, the shingle and its rank; of each set the matches it asks
    for, and how many in 127 of its shingles are rare.
    """

    row: np.ndarray
    token: np.ndarray
    rank: np.ndarray
    asks: np.ndarray
    rare: np.ndarray


def prefixes(n: np.ndarray, owner: np.ndarray, value: np.ndarray, levels: np.ndarray) -> Prefixes:
    """Rare shingles first, as far as MOST_MATCHES needs them.

    The cost of asking for m matches is the number of other documents met at the
    prefix's shingles, plus the comparisons with those (at most the meetings
    divided by m), each as dear as a part of the set's size.
    """
    level = levels[(value % np.uint64(len(levels))).astype(np.int64)]
    order = np.lexsort((value, level, owner))
    owner, value, level = owner[order], value[order], level[order]
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    rank = np.arange(len(owner)) - first[owner]
    base = n - _least_overlap(n) + 1
    rare = np.bincount(owner, weights=level == 0, minlength=len(n)) * 127 // np.maximum(n, 1)
    step = np.maximum(rank - base[owner] + 2, 1)
    keep = step <= MOST_MATCHES
    owner, value, level, step, rank = owner[keep], value[keep], level[keep], step[keep], rank[keep]
    meets = np.where(level > 0, 8.0 * 2.0 ** ((level.astype(float) - 1) / 2), 0.01)
    best = np.full(len(n), np.inf)
    asks = np.ones(len(n), dtype=np.int64)
    met = np.zeros(len(n))
    for m in range(1, MOST_MATCHES + 1):
        met += np.bincount(owner[step == m], weights=meets[step == m], minlength=len(n))
        cost = met + met / m * np.maximum(n, 16) / 16
        cost[m > _least_overlap(n)] = np.inf
        better = cost < best
        best[better], asks[better] = cost[better], m
    return Prefixes(owner, value, rank, asks, rare.astype(np.int64))


def _pack(n, rank, rare, asks) -> np.ndarray:
    """Size, rank, rare part and matches asked for in one number: 27, 25, 7 and 4 bits."""
    return (n.astype(np.int64) << 36) | (rank << 11) | (rare << 4) | asks


SIZE, RANK, RARE, ASKS = (
    "shiftright({0}, 36)", "(shiftright({0}, 11) & 33554431)", "(shiftright({0}, 4) & 127)", "({0} & 15)",
)


def _postings(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(token, key, meta) for every prefix shingle of every class."""
    state = docs.sparkSession.sparkContext.broadcast(levels)

    @tidy
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for _, n, key, owner, value in _sets(batch.column(0)):
                first = _new(key, n > 0, seen)
                kept = first[owner]
                found = prefixes(np.where(first, n, 0), owner[kept], value[kept], state.value)
                meta = _pack(n[found.row], found.rank, found.rare[found.row], found.asks[found.row])
                arrays = [pa.array(x) for x in (found.token.view(np.int64), key[found.row], meta)]
                yield pa.RecordBatch.from_arrays(arrays, ["token", "key", "meta"])

    return docs.select("text").mapInArrow(task, "token long, key long, meta long")


def _shared(postings: DataFrame) -> DataFrame:
    """Postings of shingles that several classes hold, each with its hub.

    The hub is the class with the least part of rare shingles: in a group of
    near copies that is the one most others come from.
    """
    same = Window.partitionBy("token")
    central = F.struct(F.expr(RARE.format("meta")).alias("rare"), "key", "meta")
    return (
        postings.withColumns(
            {
                "hub": F.min(central).over(same),
                "least": F.min("key").over(same),
                "last": F.max("key").over(same),
            }
        )
        .where("least <> last")
        .select("token", "key", "meta", F.col("hub.key").alias("hub"), F.col("hub.meta").alias("hub_meta"))
    )


#: Shingles that sets of sizes x.n and y.n must share, and what their signatures must have in common.
_OVERLAP = f"(({SIMILARITY[0]} * (x.n + y.n) + {sum(SIMILARITY) - 1}) DIV {sum(SIMILARITY)})"
_UNLIKE = " + ".join(f"bit_count(x.s{k} ^ y.s{k})" for k in range(SIGNATURE // 64))
#: Sets differ in at least as many shingles as their signatures do in bits.
_ALIKE = f"{_UNLIKE} <= x.n + y.n - 2 * {_OVERLAP}"
_SIGNS = [f"s{k}" for k in range(SIGNATURE // 64)]


def _stars(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of a class and a hub that it meets, unless sizes or signatures rule them out."""
    n, m = SIZE.format("meta"), SIZE.format("hub_meta")
    met = (
        shared.where("key <> hub")
        .where(f"least({n}, {m}) * {SIMILARITY[1]} >= greatest({n}, {m}) * {SIMILARITY[0]}")
        .select(F.col("key").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )
    return (
        met.alias("p")
        .join(classes.alias("x"), F.expr("p.a = x.key"))
        .join(classes.alias("y"), F.expr("p.b = y.key"))
        .where(_ALIKE)
        .select("p.a", "p.b")
    )


def _across(shared: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that aren't connected yet and share as many shingles as the larger asks for.

    A pair must have its matches within the prefixes that belong to the overlap
    its sizes demand, which are shorter than those that each set has to list.
    """
    located = (
        shared.select("token", "key", "meta")
        .dropDuplicates(["token", "key"])
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .select("token", "key", "meta", F.coalesce("root", "key").alias("root"))
    )
    same = Window.partitionBy("token")
    mixed = (
        located.withColumns({"low": F.min("root").over(same), "high": F.max("root").over(same)})
        .where("low <> high")
        .selectExpr(
            "token", "key", "root", f"{RANK.format('meta')} AS rank", f"{ASKS.format('meta')} AS asks"
        )
        .join(classes, "key")
    )
    met = mixed.alias("x").join(
        mixed.alias("y"),
        F.expr(
            "x.token = y.token AND x.root <> y.root AND (x.n > y.n OR (x.n = y.n AND x.key > y.key)) "
            f"AND y.n * {SIMILARITY[1]} >= x.n * {SIMILARITY[0]} "
            f"AND x.rank < x.n - {_OVERLAP} + x.asks AND y.rank < y.n - {_OVERLAP} + x.asks AND {_ALIKE}"
        ),
    )
    return (
        met.groupBy(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
        .agg(F.count(F.lit(1)).alias("matches"), F.max("x.asks").alias("asks"))
        .where("matches >= asks")
        .select("a", "b")
    )


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose sets are similar, compared shingle by shingle."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    state = docs.sparkSession.sparkContext.broadcast(key_filter(ends))

    @tidy
    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for _, n, key, owner, value in _sets(batch.column(0)):
                first = _new(key, (n > 0) & in_filter(state.value, key), seen)
                ends = np.cumsum(n)
                sets = [value[ends[k] - n[k] : ends[k]].tobytes() for k in np.flatnonzero(first)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[first]), pa.array(sets, pa.binary())], ["key", "shingles"]
                )

    @tidy
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for one, other in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(one.as_buffer(), dtype=np.uint64)
                y = np.frombuffer(other.as_buffer(), dtype=np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                alike.append(SIMILARITY[1] * common >= SIMILARITY[0] * (len(both) - common))
            chosen = batch.filter(pa.array(alike, pa.bool_()))
            yield chosen.select([0, 1])

    sets = (
        docs.select("text")
        .mapInArrow(fetched, "key long, shingles binary")
        .groupBy("key")
        .agg(F.first("shingles").alias("shingles"))
    )
    held = pairs.join(sets.selectExpr("key AS a", "shingles AS x"), "a").join(
        sets.selectExpr("key AS b", "shingles AS y"), "b"
    )
    return held.select("a", "b", "x", "y").mapInArrow(compared, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, class_key, component_id) for every row of `docs` (doc_id, text).

    A document's set is its distinct shingles of WORDS lower-cased words, or its
    whole word sequence if it has fewer. Two documents are linked when their
    sets' Jaccard similarity is at least SIMILARITY, compared in whole numbers;
    `component_id` is the least doc_id that links lead to, the own one included.
    Equal sets share a `class_key`. NULL, empty and blank texts have no set, a
    NULL key and no link. Repeated rows are one class, NULL ids count as larger
    than others; an empty table gives an empty one. Whole texts are compared. Ranks
    have 25 bits and sizes 27: a text of over 134 million distinct shingles isn't handled.

    Passes over the texts: one for sizes and frequencies, one for prefixes, two
    to fetch the sets that are compared. Fixed-size tables are broadcast.
    """
    found = stage(survey(docs), "near-survey")
    rows = found.where("part IS NULL").select("doc_id", "n", "key")
    signs = F.hex(F.first("packed"))
    classes = (
        found.where("part IS NULL AND n > 0")
        .groupBy("key")
        .agg(F.first("n").cast("long").alias("n"), signs.alias("signs"))
        .select(
            "key",
            "n",
            *(
                F.conv(F.substring("signs", 1 + 16 * k, 16), 16, -10).cast("long").alias(name)
                for k, name in enumerate(_SIGNS)
            ),
        )
    )
    classes = stage(classes, "near-classes")
    levels = _frequency_levels(found.where("part IS NOT NULL"))
    shared = stage(_shared(_postings(docs, levels)), "near-shared")

    links = stage(_verified(docs, stage(_stars(shared, classes), "near-stars")), "near-links")
    roots = components(links)
    more = stage(_across(shared, roots, classes), "near-pairs")
    if not more.isEmpty():
        links = links.unionByName(stage(_verified(docs, more), "near-links"))
        roots = components(links)

    classes = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    rooted = classes.join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "least", F.coalesce("root", "key").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Compared as structs, so that Spark shuffles the grouped side anew and can split a group of many classes.
    least = least.withColumnRenamed("root", "group")
    named = rooted.join(least, match_grouped(["root"], ["group"])).select("key", "component_id")
    linked = rows.where("n > 0").join(named, "key")
    alone = rows.where("n = 0")
    return linked.selectExpr(
        "doc_id", "CAST(n AS long) AS n_shingles", "key AS class_key", "component_id"
    ).unionByName(
        alone.selectExpr(
            "doc_id", "0L AS n_shingles", "CAST(NULL AS long) AS class_key", "doc_id AS component_id"
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates: the one with the least doc_id.

    Repeated rows with that id and equal text are kept once. Texts without a
    set, and rows with a NULL id, are each kept: nothing tells that they are near
    another one or which of them is meant.
    """
    found = near_duplicates(docs)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    known = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").dropDuplicates(
        ["doc_id", "text"]
    )
    return known.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))
