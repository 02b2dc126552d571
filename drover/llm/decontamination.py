"""Benchmark decontamination: BM25 over an inverted index of test items, searched by block-max WAND.

Every passage of every training text is a query against the items. Impacts are
divided by what an item must reach, so one is the threshold of all items and an
upper bound below one rules out every item of a list or block. What WAND finds
is verified by the overlap of its question and answer with the passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.llm.text import Words, lots, mix, runs, tidy, utf8

K1 = 1.2
B = 0.75
#: Part of the score that an item's own text gets, which a passage must reach.
THRESHOLD = 0.5
#: Words of the runs that question and answer are compared by, and the part of them that must be found.
RUN = 3
OVERLAP = 0.5
#: A question that is found to this part needs no answer.
SURE = 0.8
BLOCK = 16
#: Words of the shortest passages' step; longer items have steps of the next power of two.
LEAST_STEP = 8
#: Bytes of items that are searched at once; more items take more passes, each with its own broadcast.
INDEX_BYTES = 16 << 20


def question_and_answer(text: str):
    """Columns question and answer of a text column: the last sentence is the answer.

    A text of one sentence is a question without an answer.
    """
    pattern = r"(?s)^(.*[.!?])\s+(\S.*)$"
    split = F.rlike(text, F.lit(pattern))
    return (
        F.when(split, F.regexp_extract(text, pattern, 1)).otherwise(F.col(text)).alias("question"),
        F.when(split, F.regexp_extract(text, pattern, 2)).otherwise("").alias("answer"),
    )


def _word_lists(texts: list[str | None]) -> list[np.ndarray]:
    words = Words(*utf8(pa.array(texts, pa.string())))
    return np.split(words.hash, np.cumsum(words.counts)[:-1]) if texts else []


def _word_runs(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of RUN words; of the whole if it is shorter."""
    size = min(RUN, len(words))
    if not size:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        total = mix(total + words[k : len(words) - size + 1 + k])
    return np.unique(total)


class Index:
    """Inverted index of items with normalised impacts, their maxima by list and by block."""

    def __init__(
        self, items: list[tuple], frequency: dict[int, int], total: int, average: float, threshold: float,
        step: int = LEAST_STEP,
    ):
        self.step = step
        self.ids = [item[0] for item in items]
        questions = _word_lists([item[1] for item in items])
        answers = _word_lists([item[2] for item in items])
        self.questions = [_word_runs(q) for q in questions]
        self.answers = [_word_runs(a) for a in answers]
        self.threshold = threshold
        owners, terms, weights = [], [], []
        for item, (q, a) in enumerate(zip(questions, answers)):
            words = np.concatenate([q, a])
            if not len(words):
                continue
            term, tf = np.unique(words, return_counts=True)
            df = np.array([frequency[t] for t in term.tolist()])
            idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
            impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / average))
            weight = impact / (threshold * impact.sum())
            owners.append(np.full(len(term), item))
            terms.append(term)
            weights.append(weight)
        term = np.concatenate([*terms, np.zeros(0, dtype=np.uint64)])
        order = np.argsort(term, kind="stable")  # items ascend within a term
        self.terms, first, count = np.unique(term[order], return_index=True, return_counts=True)
        self.first, self.end = first, first + count
        self.owner = np.concatenate([*owners, np.zeros(0, dtype=np.int64)])[order].astype(np.int64)
        self.weight = np.concatenate([*weights, np.zeros(0)])[order]
        if len(first):
            self.most = np.maximum.reduceat(self.weight, first)
        # The longest lists are common words. They are taken as common only as far as no item
        # gets more than half of what it must reach from them.
        self.slack = np.zeros(len(items))
        self.common = np.zeros(len(first), dtype=bool)
        for k in np.argsort(-count, kind="stable").tolist():
            own = self.owner[self.first[k] : self.end[k]]
            raised = self.slack[own] + self.weight[self.first[k] : self.end[k]]
            if raised.max() <= 0.5:
                self.slack[own] = raised
                self.common[k] = True
        self.lists: dict[int, tuple] = {}

    def postings(self, term: int) -> tuple[list, list, float, list]:
        """Items, weights, greatest weight, and greatest weight of each BLOCK postings."""
        if term not in self.lists:
            owner = self.owner[self.first[term] : self.end[term]]
            weight = self.weight[self.first[term] : self.end[term]]
            blocks = np.maximum.reduceat(weight, np.arange(0, len(weight), BLOCK))
            self.lists[term] = owner.tolist(), weight.tolist(), float(self.most[term]), blocks.tolist()
        return self.lists[term]

    def search(self, query: list[int]) -> list[tuple[int, float]]:
        """Items whose impacts over the query's distinct terms reach one: block-max WAND."""
        limit = 1 - 1e-9
        cursors = [[self.postings(t), 0] for t in query]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0][0][c[1]])
            bound, pivot = 0.0, -1
            for k, (lists, _) in enumerate(cursors):
                bound += lists[2]
                if bound >= limit:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0][0][cursors[pivot][1]]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0][0][cursors[pivot + 1][1]] == item:
                pivot += 1
            bound, reach = 0.0, None
            for lists, at in cursors[: pivot + 1]:
                items = lists[0]
                block = at // BLOCK
                while block < len(lists[3]) and items[min((block + 1) * BLOCK, len(items)) - 1] < item:
                    block += 1
                if block < len(lists[3]):
                    bound += lists[3][block]
                    last = items[min((block + 1) * BLOCK, len(items)) - 1]
                    reach = last if reach is None else min(reach, last)
            if bound >= limit:
                score = 0.0
                for lists, at in cursors[: pivot + 1]:
                    while at < len(lists[0]) and lists[0][at] < item:
                        at += 1
                    if at < len(lists[0]) and lists[0][at] == item:
                        score += lists[1][at]
                if score >= limit:
                    found.append((item, score))
                target = item + 1
            else:
                # No item up to the end of the nearest block, or before the next list's item, can do.
                target = item + 1 if reach is None else reach + 1
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0][0][cursors[pivot + 1][1]])
                target = max(target, item + 1)
            moved = []
            for cursor in cursors:
                items, at = cursor[0][0], cursor[1]
                if items[at] < target:
                    while at < len(items) and items[at] < target:
                        at += 1
                    cursor[1] = at
                if at < len(items):
                    moved.append(cursor)
            cursors = moved
        return found

    def leaks(self, words: Words) -> Iterator[tuple[int, int, float, float, float, int]]:
        """Of some texts' words: text, item, score, question and answer overlap, passage's first word.

        Passages are runs of two steps that start at every multiple of a step. No item
        has more words than a step, so each place where one could stand lies
        within a passage.
        """
        if not len(self.terms):
            return
        step = self.step
        place = np.minimum(np.searchsorted(self.terms, words.hash), len(self.terms) - 1)
        known = self.terms[place] == words.hash
        start = np.cumsum(words.counts) - words.counts
        rows, first = self._able(words, place, known, start, step)
        end = np.minimum(first + 2 * step, start[rows] + words.counts[rows])
        best: dict[tuple[int, int], tuple] = {}
        for row, a, b in zip(rows.tolist(), first.tolist(), end.tolist()):
            query = np.unique(place[a:b][known[a:b]])
            passage = None
            for item, score in self.search(query.tolist()):
                if passage is None:
                    passage = _word_runs(words.hash[a:b])
                question, answer = (
                    self._overlap(x, passage, words.hash[a:b]) for x in (self.questions[item], self.answers[item])
                )
                if question < OVERLAP or (answer < OVERLAP and question < SURE):
                    continue
                value = (min(score * self.threshold, 1.0), question, answer, a - int(start[row]))
                key = (row, item)
                # Of equal passages the first one stays.
                if key not in best or value[:3] > best[key][:3]:
                    best[key] = value
        for (row, item), value in sorted(best.items()):
            yield row, item, *value

    def _able(self, words: Words, place, known, start, step) -> tuple[np.ndarray, np.ndarray]:
        """Passages (text and first word) in which some item may reach one.

        The impacts of the rarer words are added up exactly for every passage
        and item that share one; the common words can add an item's slack.
        """
        hits = np.flatnonzero(known & ~self.common[place])
        text = words.text[hits]
        window = (hits - start[text]) // step
        # Every word lies in two passages; a word counts once in each.
        passage = np.concatenate([start[text] + window * step, start[text] + (window - 1) * step])
        term = np.concatenate([place[hits], place[hits]])
        inside = np.concatenate([window >= 0, window >= 1])
        pair = np.unique(passage[inside] * len(self.terms) + term[inside])
        passage, term = pair // len(self.terms), pair % len(self.terms)
        size = self.end[term] - self.first[term]
        posting = np.repeat(self.first[term] - np.cumsum(size) + size, size) + np.arange(size.sum())
        key = np.repeat(passage, size) * len(self.ids) + self.owner[posting]
        order = np.argsort(key, kind="stable")
        key, first = key[order], runs(key[order])
        if not len(first):
            return first, first
        sums = np.add.reduceat(self.weight[posting][order], first)
        item = key[first] % len(self.ids)
        able = np.unique((key[first] // len(self.ids))[sums + self.slack[item] >= 1 - 1e-6])
        return words.text[able], able

    @staticmethod
    def _overlap(part: np.ndarray, passage: np.ndarray, words: np.ndarray) -> float:
        """Part of the runs that the passage holds; shorter parts are looked for as they are."""
        if not len(part):
            return 1.0
        found = np.isin(part, passage)
        if not found.all() and len(part) == 1:
            for size in range(1, RUN):
                total = np.zeros(max(len(words) - size + 1, 0), dtype=np.uint64)
                for k in range(size if len(total) else 0):
                    total = mix(total + words[k : len(words) - size + 1 + k])
                found |= np.isin(part, total)
        return float(found.mean())


class Indexes:
    """Indexes of several item lengths, which go over a task's texts together."""

    def __init__(self, parts: list[Index]):
        self.parts = parts

    def leaks(self, column: pa.Array) -> Iterator[tuple]:
        """Of a text column: row, item's id, score, question and answer overlap, passage's first word."""
        for low, _, data, offsets in lots(column):
            words = Words(data, offsets)
            if len(words.hash):
                for index in self.parts:
                    for row, item, *value in index.leaks(words):
                        yield low + row, index.ids[item], *value


def build_indexes(items: DataFrame, threshold: float = THRESHOLD, index_bytes: int = INDEX_BYTES) -> Iterator[Indexes]:
    """Indexes over all items (item_id, question, answer), together about `index_bytes` of text at a time.

    Items are indexed by their length: the passages of an item have twice as many
    words as the next power of two above its own, so what is found of
    it does not depend on other items. Document frequencies and the average length are those
    of all items. Which items lie in one index changes nothing either.
    """
    text = F.concat_ws(" ", "question", "answer")
    frame = items.select("item_id", "question", "answer").withColumn("text", text)
    words = F.greatest(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(LEAST_STEP))
    digits = F.length(F.bin(words.cast("long") - 1))
    frame = frame.withColumn("step", F.pow(F.lit(2), digits).cast("int"))

    @tidy
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in lots(batch.column(0)):
                words = Words(data, offsets)
                pairs = np.unique(np.stack([words.text.astype(np.uint64), words.hash]), axis=1)
                length = words.counts[pairs[0].astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[1].view(np.int64)), pa.array(length)], ["term", "length"]
                )

    held = frame.select("text").mapInArrow(terms, "term long, length long").groupBy("term").count()
    sizes = frame.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("items")).first()
    if not sizes["items"]:
        return

    @tidy
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = Words(*utf8(batch.column(0))).counts
            yield pa.RecordBatch.from_arrays([pa.array([int(count.sum())])], ["words"])

    words = frame.select("text").mapInArrow(lengths, "words long").agg(F.sum("words").alias("w")).first()["w"]
    average = max((words or 0) / sizes["items"], 1.0)
    # What is collected here is at most one row for each length class, then `index_bytes` of items at a time.
    classes = frame.groupBy("step").agg(F.sum(F.octet_length("text")).alias("bytes")).orderBy("step").collect()
    units = []
    for row in classes:
        parts = 1 + (row["bytes"] or 0) // index_bytes
        units += [(row["step"], k, parts, (row["bytes"] or 0) / parts) for k in range(parts)]
    while units:
        chosen, size = [units.pop(0)], 0.0
        while units and size + chosen[-1][3] + units[0][3] <= index_bytes:
            size += chosen[-1][3]
            chosen.append(units.pop(0))
        part = F.xxhash64("item_id", "text")
        some = frame.where(
            reduce(lambda a, b: a | b, ((F.col("step") == s) & (F.pmod(part, F.lit(n)) == k) for s, k, n, _ in chosen))
        )
        own = some.select("text").mapInArrow(terms, "term long, length long").select("term").distinct()
        frequency = {r["term"] % 2**64: r["count"] for r in own.join(held, "term").collect()}
        rows = [(r["step"], r["item_id"], r["question"], r["answer"]) for r in some.collect()]
        rows.sort(key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
        steps = {s: [r[1:] for r in rows if r[0] == s] for s in dict.fromkeys(r[0] for r in rows)}
        yield Indexes(
            [Index(own_rows, frequency, sizes["items"], average, threshold, s) for s, own_rows in steps.items()]
        )


def find_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, first_word): items found in texts.

    An item is found if some passage reaches `threshold` of the BM25 score that
    the item's own text gets, and holds enough of its question and answer: runs
    of RUN words, OVERLAP of both, or SURE of the question. `first_word` is where
    the best such passage starts, the first of equal ones. All words of all texts are searched. NULL and
    empty texts and items hold nothing; repeated rows are reported again, as are
    items with equal ids; without items or documents there are no rows.
    """
    spark = docs.sparkSession
    schema = (
        "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
        "first_word long"
    )
    found = spark.createDataFrame([], schema)
    frame = docs.select(F.col("doc_id").cast("long"), "text")
    for index in build_indexes(items, **options):
        state = spark.sparkContext.broadcast(index)

        @tidy
        def task(batches, state=state):
            for batch in batches:
                rows = list(state.value.leaks(batch.column(1)))
                columns = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(columns[0], pa.int64())),
                        pa.array(columns[1], pa.int64()),
                        *(pa.array(c, pa.float64()) for c in columns[2:5]),
                        pa.array(columns[5], pa.int64()),
                    ],
                    schema=pa.schema(
                        [("doc_id", pa.int64()), ("item_id", pa.int64())]
                        + [(c, pa.float64()) for c in ("score", "question_overlap", "answer_overlap")]
                        + [("first_word", pa.int64())]
                    ),
                )

        found = found.unionByName(frame.mapInArrow(task, schema))
    return found


def without_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows in whose text no item is found; rows stay in their tasks."""
    spark, names = docs.sparkSession, docs.columns
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    frame = docs.select(row, "text")
    kind = frame.schema["row"].dataType.simpleString()
    for index in build_indexes(items, **options):
        state = spark.sparkContext.broadcast(index)

        @tidy
        def task(batches, state=state):
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[leak[0] for leak in state.value.leaks(batch.column(1))]] = False
                yield batch.filter(pa.array(clean))

        frame = frame.mapInArrow(task, f"row {kind}, text string")
    return frame.select(*(F.col(f"row.`{c}`") for c in names))
