"""Packing by power-of-two decomposition: every piece is a sequence, and none crosses documents."""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from drover.llm.text import tidy

#: Bytes that a Python worker's known words may take: half for those met lately, half for those before.
KEPT_BYTES = 128 << 20
#: Bytes that a word of the store takes besides its letters and ids.
ENTRY_BYTES = 250
#: Characters that are encoded at once; a longer text is cut at blanks.
LOT = 1 << 20
#: A longer word is left whole to the tokenizer, so that its parts don't fill the store.
LONG = 1000
#: Visible characters that Python and the tokenizer lower-case, compose and classify alike: no dotted I.
PLAIN = "".join(chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0x250)] if c != 0x130)
#: A text with such a character, or with what may be a special token, is not lower-cased ahead.
UNSAFE = "[^\u0000-\u024f\u2000-\u2069]|\u0130|<\\|"

_LETTERS, _DIGITS = ("".join(c for c in PLAIN if unicodedata.category(c)[0] == kind) for kind in "LN")
_is_plain = re.compile(f"[{re.escape(PLAIN)}]+").fullmatch
#: The tokenizer's splitter, for plain characters.
_split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}]+").findall
_byte_level = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
#: The bytes of a plain character as the letters that the merges know.
_BYTES = {ord(c): _byte_level(c)[0][0] for c in PLAIN}


class Encoder:
    """Ids of texts, by way of their distinct words.

    The tokenizer splits at white space and drops it, so the ids of a text are
    those of the parts between its blanks and line breaks, one after the other.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        # Words met lately; when they fill their half they become the older ones, and those go.
        self.store: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def _of_word(self, word: str) -> bytes:
        """Ids of a part without blanks, as little-endian unsigned 32-bit numbers.

        Plain words are split here, and each part in lower case goes to the merges at once;
        a part is split no further. All else, special tokens too, is the tokenizer's.
        """
        if not (word.isascii() and word.isalpha() and word.islower()):
            lower = word.lower()
            if len(word) > LONG or not (_is_plain(lower) and _is_plain(word)) or "<|" in word:
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
                return array("I", ids).tobytes()
            parts = _split(lower)
            if len(parts) > 1:
                return b"".join(map(self.of, parts))
            if lower != word:
                return self.of(lower)
            if not word.isascii():
                word = word.translate(_BYTES)
        return array("I", [token.id for token in self.merges(word)]).tobytes()

    def of(self, word: str) -> bytes:
        known = self.store.get(word)
        if known is None:
            known = self.older.get(word)
            if known is None:
                known = self._of_word(word)
            self.store[word] = known
            self.size += ENTRY_BYTES + 4 * len(word) + len(known)
        return known

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin (one more: the end)."""
        if self.size > KEPT_BYTES // 2:
            self.older, self.store, self.size = self.store, {}, 0
        column = pa.array(texts, pa.large_string())
        # Fewer different words; the tokenizer would do the same.
        column = pc.if_else(pc.match_substring_regex(column, UNSAFE), column, pc.utf8_lower(column))
        split = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        parts = pc.list_flatten(split).dictionary_encode()
        words = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.store.get, words))
        if None in known:
            known = [self.of(word) if ids is None else ids for word, ids in zip(words, known)]
        placed = pa.array(known, pa.large_binary()).take(parts.indices)
        ends = np.frombuffer(placed.buffers()[1], dtype=np.int64)[: len(placed) + 1] // 4
        ids = np.frombuffer(placed.buffers()[2] or b"", dtype="<u4")[: ends[-1]]
        return ids, ends[split.offsets.to_numpy()]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(text: str, limit: int = LOT) -> Iterator[str]:
    """The text in parts of about `limit` characters that end at blanks or line breaks."""
    at = 0
    while len(text) - at > limit:
        end = max(text.rfind(" ", at, at + limit), text.rfind("\n", at, at + limit)) + 1
        if not end:
            ends = [e for e in (text.find(" ", at + limit), text.find("\n", at + limit)) if e >= 0]
            if not ends:
                break
            end = min(ends) + 1
        yield text[at:end]
        at = end
    yield text[at:]


def lengths(total: int, longest: int) -> list[int]:
    """Pieces of a document: whole `longest` ones, then the binary digits of the rest, large first."""
    whole, rest = divmod(total, longest)
    return [longest] * whole + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pack(
    docs: DataFrame, tokenizer_path: str, longest: int = 2048, end_id: int = 1, with_ids: bool = True
) -> DataFrame:
    """Cut the token ids of every document into pieces whose lengths are powers of two.

    A document is its ids followed by `end_id`; pieces are at most `longest`
    ids, a power of two. Every piece is one sequence, so nothing is padded and
    no sequence holds two documents; sequences of one `length` form a bucket
    from which equal batches are drawn (`bucket_sizes`, `write_buckets`).

    Returns doc_id, start, length, ids (if asked), ids_crc32, doc_tokens,
    sequence_id and offset (always 0); other columns are dropped. NULL and empty
    texts give one piece with the end id alone. Repeated rows and NULL ids are
    packed as often as they occur; an empty table gives no piece. A special token
    of the tokenizer that a text spells out, in its own case, is its id. Rows never
    move between tasks; a task encodes about a million characters at a time and
    holds the ids of one document.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    ids_field = [pa.field("ids", pa.list_(pa.int32()))] if with_ids else []
    schema = pa.schema(
        [
            pa.field("doc_id", pa.int64()),
            pa.field("start", pa.int64()),
            pa.field("length", pa.int64()),
            *ids_field,
            pa.field("ids_crc32", pa.int64()),
            pa.field("doc_tokens", pa.int64()),
        ]
    )
    end = np.array([end_id], dtype="<u4")

    def pieces(found: list[tuple[int | None, list[np.ndarray]]]) -> pa.RecordBatch:
        """Documents with their ids as rows."""
        rows: list[tuple] = []
        kept: list[np.ndarray] = []
        for doc_id, parts in found:
            ids = np.concatenate([*parts, end])
            start = 0
            for length in lengths(len(ids), longest):
                piece = ids[start : start + length]
                rows.append((doc_id, start, length, zlib.crc32(piece), len(ids)))
                kept.append(piece)
                start += length
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
        if with_ids:
            starts = np.concatenate([[0], np.cumsum([len(x) for x in kept])]).astype(np.int32)
            columns.insert(3, pa.ListArray.from_arrays(starts, pa.array(np.concatenate(kept).view("<i4"))))
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    @tidy
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        # Documents whose ids are wanted, the last one perhaps in part; `lot` has the parts still to encode.
        waiting: list[tuple[int | None, list[np.ndarray]]] = []
        lot: list[tuple[int, str]] = []
        size = 0

        def settle() -> None:
            ids, bounds = encode([part for _, part in lot])
            for (k, _), low, high in zip(lot, bounds, bounds[1:]):
                waiting[k][1].append(ids[low:high])
            lot.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                waiting.append((doc_id, []))
                for part in cut(text.as_py() or ""):
                    if size + len(part) > LOT and lot:
                        settle()
                        size = 0
                        if len(waiting) > 1:
                            yield pieces(waiting[:-1])
                            del waiting[:-1]
                    lot.append((len(waiting) - 1, part))
                    size += len(part)
        if waiting:
            settle()
            yield pieces(waiting)

    packed = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        task, from_arrow_schema(schema)
    )
    # Task number and row number within it: the same again when a lost task is repeated.
    return packed.withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )


def bucket_sizes(packed: DataFrame) -> DataFrame:
    """Sequences and tokens in each bucket of equal lengths."""
    return packed.groupBy("length").agg(
        F.count(F.lit(1)).alias("sequences"), F.sum("length").alias("tokens")
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per length, written by the tasks that made the pieces."""
    packed.write.partitionBy("length").parquet(path)
