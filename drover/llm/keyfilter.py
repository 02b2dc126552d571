"""A bitmap of fixed size over 64-bit keys, to fetch from the texts little more than what is asked for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from drover.llm.text import mix, tidy

#: Bits of the filter. Beyond its capacity more is fetched than needed, never less.
FILTER_BITS = 1 << 24
SLICES = 64


def key_filter(keys: DataFrame) -> np.ndarray:
    """Bitmap of fixed size that holds every `key`, and by chance a few others."""
    size = FILTER_BITS // SLICES

    @tidy
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            key = mix(batch.column(0).to_numpy().view(np.uint64))
            bits[(key % np.uint64(FILTER_BITS)).astype(np.int64)] = True
        press = zstandard.ZstdCompressor(level=1)
        for part in range(SLICES):
            piece = bits[part * size : (part + 1) * size]
            if piece.any():
                packed = press.compress(np.packbits(piece).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([packed], pa.binary())], ["part", "packed"]
                )

    @tidy
    def united(table: pa.Table) -> pa.Table:
        unpress, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        bits = np.zeros(size // 8, dtype=np.uint8)
        for packed in table.column("packed"):
            bits |= np.frombuffer(unpress.decompress(packed.as_py()), dtype=np.uint8)
        return pa.table(
            {"part": table.column("part").slice(0, 1), "packed": [press.compress(bits.tobytes())]}
        )

    found = (
        keys.mapInArrow(marked, "part int, packed binary")
        .groupBy("part")
        .applyInArrow(united, "part int, packed binary")
    )
    bits = np.zeros((SLICES, size // 8), dtype=np.uint8)
    unpress = zstandard.ZstdDecompressor()
    for row in found.toLocalIterator():  # at most SLICES rows
        bits[row["part"]] = np.frombuffer(unpress.decompress(row["packed"]), dtype=np.uint8)
    return bits.reshape(-1)


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (mix(keys.view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)
    return (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
