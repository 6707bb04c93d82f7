"""Quality scores: random Fourier features, ridge by normal equations, isotonic scale.

Each text becomes a fixed number of statistics. Random cosines of these
approximate a Gaussian kernel. Labelled rows give each partition's part of the
normal equations; the parts are summed by row of the matrix, so the driver gets
one matrix a fold whatever the size. Outputs by the weights of other folds calibrate
the scale, by pooling adjacent violators over counts on a fixed grid.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from firstseen.llm.frames import fresh_names, staged

FEATURES = 256
RIDGE = 1e-3
# Width of the kernel over standardised statistics.
WIDTH = 6.0
# Cells of the grid the ridge output is counted on for calibration.
GRID = 2000
GRID_LOW, GRID_HIGH = -1.0, 2.0
THRESHOLD = 0.3
# Of five parts by checksum, the one that is never learnt from.
HELD_OUT = 0

STATISTICS = (
    "log_chars log_words mean_word upper digit space line stop_mark other_mark symbol beyond_ascii "
    "distinct_words top_word repeats distinct_pairs distinct_lines mean_line long_words one_letter max_word "
    "capitalised distinct_bytes"
).split()
_KINDS = np.zeros(256, np.uint8)
for _kind, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r", b"\n", b".,", b"'\"-:;?()", b"!#$%&*+/<=>@[\\]^_`{|}~"), 1):
    _KINDS[list(_bytes)] = _kind
_KINDS[128:] = 8


def statistics(text: str) -> np.ndarray:
    """The statistics of a text; all zero for an empty one."""
    out = np.zeros(len(STATISTICS))
    words = text.split()
    if not words:
        out[0] = np.log1p(len(text))
        return out
    raw = np.frombuffer(text.encode(), np.uint8)
    by_byte = np.bincount(raw, minlength=256)
    kinds = np.bincount(_KINDS, weights=by_byte, minlength=9) / len(raw)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts, n = Counter(words), len(words)
    lines = text.split("\n")
    out[:3] = np.log1p(len(text)), np.log1p(n), lengths.mean()
    out[3:11] = kinds[1:9]
    out[11:15] = (
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(zip(words, words[1:], strict=False))) / max(n - 1, 1),
    )
    out[15:17] = len(set(lines)) / len(lines), np.log1p(len(text) / len(lines))
    out[17:20] = (lengths > 14).mean(), (lengths == 1).mean(), np.log1p(lengths.max())
    out[20:] = sum(map(str.istitle, words)) / n, np.count_nonzero(by_byte) / 256
    return out


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(text or "") for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "stats"]
        )


def document_statistics(documents: DataFrame) -> DataFrame:
    columns = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return columns.mapInArrow(_statistics, "doc_id bigint, stats array<double>")


def fold(doc_id: Column) -> Column:
    """Which of five parts a document belongs to."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


@dataclass(frozen=True)
class Model:
    """What scoring needs; its size does not depend on the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random cosines and a constant."""
        scaled = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(scaled @ self.directions + self.phases) * np.sqrt(2 / self.directions.shape[1])
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.values)


def isotonic(weights: np.ndarray, means: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence closest to ``means`` in weighted squares."""
    blocks: list[list[float]] = []
    for weight, mean in zip(weights.tolist(), means.tolist(), strict=True):
        blocks.append([weight, mean, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            (w, m, n), (w0, m0, n0) = blocks.pop(), blocks.pop()
            blocks.append([w + w0, (w * m + w0 * m0) / (w + w0), n + n0])
    return np.concatenate([np.full(int(n), m) for _, m, n in blocks]) if blocks else np.zeros(0)


def _moments(stats: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    columns = [F.col("stats")[k] for k in range(len(STATISTICS))]
    row = stats.agg(*(F.avg(c) for c in columns), *(F.stddev_pop(c) for c in columns)).first()
    mean, scale = (np.array([x or 0.0 for x in part]) for part in (row[: len(columns)], row[len(columns) :]))
    return mean, np.where(scale > 1e-9, scale, 1.0)


def _normal_equations(rows: DataFrame, model: Model) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Z'Z, Z'y and the number of rows by fold, from one partial sum per partition."""
    size = len(model.phases) + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, part in batch.groupby("fold"):
                z = model.features(np.stack(part["stats"].to_numpy()))
                gram = grams.setdefault(int(number), np.zeros((size, size + 1)))
                gram += z.T @ np.hstack([z, part[["label"]].to_numpy()])
        for number, gram in grams.items():
            yield pd.DataFrame({"fold": number, "line": np.arange(size), "sums": list(gram)})

    def summed(lines: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(lines["sums"].to_numpy()), axis=0)
        return pd.DataFrame({"fold": lines["fold"].iloc[:1], "line": lines["line"].iloc[:1], "sums": [total]})

    schema = "fold bigint, line bigint, sums array<double>"
    parts = rows.select(F.col("fold").cast("bigint").alias("fold"), "stats", "label").mapInPandas(partial, schema)
    grams: dict[int, np.ndarray] = {}
    for row in parts.groupBy("fold", "line").applyInPandas(summed, schema).collect():
        grams.setdefault(row.fold, np.zeros((size, size + 1)))[row.line] = row.sums
    return {number: (gram[:, :size], gram[:, size], gram[size - 1, size - 1]) for number, gram in grams.items()}


def _ridge(parts: Iterable[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    gram, target, n = (sum(column) for column in zip(*parts, strict=True))
    return np.linalg.solve(gram + RIDGE * n * np.eye(len(gram)), target)


def fit(stats: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """Learn from all labelled rows outside the held-out part.

    Rows without label or id are not learnt from; a document labelled twice counts
    twice. The scale is calibrated by cross-fitting: each row of a fold by weights
    of the other folds, or of its own where no other has labels. Without any
    labelled row every score is one half.
    """
    mean, scale = _moments(stats)
    random = np.random.default_rng(seed)
    directions = random.normal(size=(len(STATISTICS), FEATURES)) / WIDTH
    phases = random.uniform(0, 2 * np.pi, FEATURES)
    empty = np.zeros(FEATURES + 1)
    half = np.array([0.5, 0.5])
    model = Model(mean, scale, directions, phases, empty, np.array([0.0, 1.0]), half)
    labelled = stats.join(
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("label")).dropna(),
        "doc_id",
    ).withColumn("fold", fold(F.col("doc_id")))
    labelled = staged(labelled.filter(F.col("fold") != HELD_OUT), "labelled-statistics")
    parts = _normal_equations(labelled, model)
    if not parts:
        return model
    weights = _ridge(parts.values())
    without = {number: [part for other, part in parts.items() if other != number] for number in parts}
    crossed = {number: _ridge(others) if others else weights for number, others in without.items()}
    model = Model(mean, scale, directions, phases, weights, model.knots, half)
    return Model(mean, scale, directions, phases, weights, *_calibrate(labelled, model, crossed))


def _calibrate(rows: DataFrame, model: Model, weights: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the isotonic scale, from counts by cell of the grid."""

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, part in batch.groupby("fold"):
                found = model.features(np.stack(part["stats"].to_numpy())) @ weights[int(number)]
                raw = np.clip(found, GRID_LOW, GRID_HIGH)
                cell = ((raw - GRID_LOW) / (GRID_HIGH - GRID_LOW) * GRID).astype(np.int64)
                yield pd.DataFrame({"cell": cell, "label": part["label"].to_numpy()})

    counted = (
        rows.select("fold", "stats", "label")
        .mapInPandas(cells, "cell bigint, label double")
        .groupBy("cell")
        .agg(F.count("*").alias("n"), F.avg("label").alias("mean"))
        .toPandas()
        .sort_values("cell")
    )
    middle = GRID_LOW + (counted["cell"].to_numpy() + 0.5) * (GRID_HIGH - GRID_LOW) / GRID
    return middle, isotonic(counted["n"].to_numpy(float), counted["mean"].to_numpy(float))


def score_statistics(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of staged statistics."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = np.array(batch.column("stats").flatten()).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(matrix))], names=["doc_id", "score"])

    return stats.mapInArrow(scored, "doc_id bigint, score double").select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every whole text; one row per document.

    A null text is empty. Rows of one doc_id are scored each by its own text. A
    null doc_id is scored and its ``held_out`` is null. An empty table gives none.
    """
    stats = staged(document_statistics(documents), "statistics")
    return score_statistics(stats, fit(stats, labels))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, all columns, whose text scores the threshold or more.

    Rows are staged with their statistics, so each text is read for them once. Null
    texts, repeated rows and empty tables are as in ``classify``.
    """
    (name,) = fresh_names(documents, "stats")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(text or "") for text in batch.column("text").to_pylist()]
            yield batch.append_column(name, pa.array(rows, pa.list_(pa.float64())))

    schema = StructType([*documents.schema.fields, StructField(name, ArrayType(DoubleType()))])
    held = staged(documents.mapInArrow(measured, schema), "measured-documents")
    model = fit(held.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(name).alias("stats")), labels)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = np.array(batch.column(name).flatten()).reshape(batch.num_rows, -1)
                kept = batch.filter(pa.array(model.score(matrix) >= threshold))
                yield kept.select([field for field in kept.schema.names if field != name])

    return held.mapInArrow(good, documents.schema)
