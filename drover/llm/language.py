"""Language identification by the nearest of several TF-IDF n-gram centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drover.llm.text import LOWER, lots, mix, tidy
from drover.session import stage

#: Buckets that byte n-grams are hashed to.
DIMENSIONS = 8192
GRAMS = (2, 3)
#: Bound of the labelled sample that the classifier is fitted on, for each language.
SAMPLE_PER_LANGUAGE = 400
CENTROIDS = 4
#: Rejected are texts whose cosine is below this part of the least one that training texts
#: of as many n-grams have, or below the floor.
SLACK = 0.25
FLOOR = 0.02
UNDETERMINED = "und"

_LETTER = np.zeros(256, dtype=np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams of lower-cased letters, one row per text; the rest is a blank."""
    texts = len(offsets) - 1
    code = _LETTER[LOWER[data]].astype(np.uint32)
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    counts = np.zeros(texts * DIMENSIONS, dtype=np.float32)
    for size in GRAMS:
        if len(code) < size:
            continue
        gram = np.zeros(len(code) - size + 1, dtype=np.uint64)
        for k in range(size):
            gram = gram * np.uint64(256) + code[k : len(code) - size + 1 + k]
        inside = (owner[size - 1 :] == owner[: len(gram)]) & (gram > 0)
        bucket = mix(gram[inside] + np.uint64(size << 40)) % np.uint64(DIMENSIONS)
        place = owner[: len(gram)][inside] * DIMENSIONS + bucket.astype(np.int64)
        counts += np.bincount(place, minlength=len(counts)).astype(np.float32)
    return counts.reshape(texts, DIMENSIONS)


def vectors(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Counts in small lots of texts: first row, end row, counts, whether there is a letter."""
    for at, end, data, offsets in lots(column, 1 << 20):
        for low in range(at, end, 128):
            high = min(low + 128, end)
            span = offsets[low - at : high - at + 1]
            part = data[span[0] : span[-1]]
            counts = term_counts(part, span - span[0])
            yield low, high, counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of (1 + log tf) * idf; a text without n-grams is the zero vector."""
    weights = np.log1p(counts) * idf
    norms = np.linalg.norm(weights, axis=1, keepdims=True)
    return weights / np.where(norms > 0, norms, 1)


@dataclass
class Model:
    """Fitted centroids; `radius` is the least cosine per root of distinct n-grams."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    radius: np.ndarray


def reach(counts: np.ndarray) -> np.ndarray:
    """Root of the number of distinct n-grams, to which the cosine of a short text is in proportion."""
    return np.sqrt(np.clip((counts > 0).sum(axis=1), 1, 100))


def _clustered(points: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means from evenly spaced starting points; empty clusters are left out."""
    centres = points[np.linspace(0, len(points) - 1, min(count, len(points))).astype(int)]
    for _ in range(10):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.stack([points[nearest == k].sum(axis=0) for k in range(len(centres))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = (sums / np.where(norms > 0, norms, 1))[norms[:, 0] > 0]
    return centres


def fit(
    labelled: DataFrame,
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    centroids: int = CENTROIDS,
) -> Model:
    """Fit IDF and centroids on at most `sample_per_language` rows of each `lang`.

    `labelled` has doc_id, text and lang. The sample is the rows with the least
    hashes of doc_id, so it doesn't depend on the layout. Rows with NULL doc_id,
    lang or text, and texts without a letter, teach nothing. Centroids are found
    by one task per language over its sample.
    """
    spark = labelled.sparkSession
    rows = labelled.select("doc_id", "lang", "text").where("doc_id IS NOT NULL AND lang IS NOT NULL")
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    chosen = (
        rows.where(F.rlike("text", F.lit(r"\p{L}")))
        .select("lang", "doc_id", F.xxhash64("doc_id").alias("draw"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= sample_per_language)
        .select("lang", "doc_id")
        .distinct()
    )
    # At most sample_per_language rows for each language.
    sample = stage(rows.join(F.broadcast(chosen), ["lang", "doc_id"]), "language-sample")

    @tidy
    def held(batches):
        for batch in batches:
            df = np.zeros(DIMENSIONS, dtype=np.int64)
            for _, _, counts in vectors(batch.column(0)):
                df += (counts > 0).sum(axis=0)
            df[0] = df[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(DIMENSIONS), pa.int32()), pa.array(df), pa.array([batch.num_rows] * DIMENSIONS)],
                ["term", "docs", "total"],
            )

    found = (
        sample.select("text")
        .mapInArrow(held, "term int, docs long, total long")
        .groupBy("term")
        .agg(F.sum("docs").alias("docs"), F.sum("total").alias("total"))
        .toPandas()  # one row per hash bucket
    )
    idf = np.zeros(DIMENSIONS, dtype=np.float32)
    if len(found):
        idf[found.term] = np.log((1 + found.total) / (1 + found.docs)) + 0.05

    @tidy
    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id", kind="stable")
        lots_of = [c for _, _, c in vectors(pa.array(frame["text"], pa.string()))]
        counts = np.concatenate(lots_of)
        points = weighted(counts, idf)
        used = points.any(axis=1)
        points, counts = points[used], counts[used]
        if not len(points):
            return pd.DataFrame({"lang": [], "centre": [], "radius": []})
        centres = _clustered(points, centroids)
        cosine = points @ centres.T
        nearest, best = cosine.argmax(axis=1), cosine.max(axis=1) / reach(counts)
        least = [best[nearest == k].min() if (nearest == k).any() else 0.0 for k in range(len(centres))]
        return pd.DataFrame(
            {"lang": frame["lang"].iloc[0], "centre": [c.tolist() for c in centres], "radius": least}
        )

    fitted = sample.groupBy("lang").applyInPandas(
        cluster, "lang string, centre array<float>, radius double"
    )
    rows_fitted = sorted(fitted.collect(), key=lambda r: (r["lang"], r["centre"]))
    languages = sorted({r["lang"] for r in rows_fitted})
    return Model(
        languages,
        idf,
        np.array([r["centre"] for r in rows_fitted], dtype=np.float32).reshape(-1, DIMENSIONS),
        np.array([languages.index(r["lang"]) for r in rows_fitted], dtype=np.int64),
        np.array([r["radius"] for r in rows_fitted], dtype=np.float32),
    )


def identify(docs: DataFrame, model: Model, slack: float = SLACK, floor: float = FLOOR) -> DataFrame:
    """Adds lang_pred, score and rejected, in place of columns of these names.

    `lang_pred` is the language of the centroid with the highest cosine, `score`
    that cosine (0 to 1). A text is rejected if it is farther from its nearest
    centroid than `slack` allows, given how many distinct n-grams it has. NULL
    texts and texts without a letter get `und`, score 0, and are rejected, as is
    every text under a model without languages. Rows stay in their tasks;
    repeated rows get equal results, an empty table an empty one.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    names = docs.columns
    letter = F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False))
    # Positions instead of names, so that no name of the input can clash.
    frame = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names if c != "text")).alias("row") if len(names) > 1 else F.lit(0).alias("row"),
        "text", letter.alias("letter"),
    )
    state = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = state.value
        for batch in batches:
            rows = batch.num_rows
            best = np.zeros(rows, dtype=np.int64)
            score, least = np.zeros(rows), np.zeros(rows)
            if len(model.owner):
                for low, high, counts in vectors(batch.column(1)):
                    cosine = weighted(counts, model.idf) @ model.centroids.T
                    nearest = cosine.argmax(axis=1)
                    best[low:high] = model.owner[nearest]
                    score[low:high] = np.clip(cosine.max(axis=1), 0, 1)
                    least[low:high] = model.radius[nearest] * slack * reach(counts)
            letter = batch.column(2).to_numpy(zero_copy_only=False)
            known = letter & bool(len(model.owner))
            names_found = np.array([*model.languages, UNDETERMINED], dtype=object)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(names_found[np.where(known, best, -1)], pa.string()),
                    pa.array(np.where(known, score, 0.0)),
                    pa.array(~known | (score < np.maximum(least, floor))),
                ],
                ["row", "text", "lang_pred", "score", "rejected"],
            )

    kind = frame.schema["row"].dataType.simpleString()
    out = frame.mapInArrow(task, f"row {kind}, text string, lang_pred string, score double, rejected boolean")
    return out.select(
        *("text" if c == "text" else F.col(f"row.`{c}`") for c in names),
        "lang_pred",
        "score",
        "rejected",
    )
