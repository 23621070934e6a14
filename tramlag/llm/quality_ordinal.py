"""Ordinal cumulative-link regression on graded ratings over hashed text.

One vector of weights over hashed features is shared by all grades; ordered thresholds cut its
score into grades: P(grade > k) = sigmoid(score - threshold k). The expected grade and the tail
probability of a wanted grade follow. Features are counted in every whole text inside tasks;
only the fit, on a bounded sample of rated rows, happens on the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramlag.llm.common import extended, first_by_hash, free, slices

#: Rated rows that the fit uses at most (those first by a hash of their id), and the hashed space.
FIT_ROWS = 6_000
BUCKETS = 1 << 14
TEXT_BYTES = 4 << 20

# byte -> class: letters a and A, digits 0, every byte of a longer UTF-8 character a
_SHAPE = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, value) of a text's hashed features; a text without words has none.

    Words, and word shapes (letters, capitals, digits and signs, runs of a class as one) with
    their pairs; values are square roots of shares. The last buckets hold the shares of lines
    and words that repeat earlier ones, and the share of long words.
    """
    if not text:
        return np.zeros(0, np.int64), np.zeros(0)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    kinds = np.frombuffer(raw.translate(_SHAPE), np.uint8)
    shapes = kinds[np.diff(kinds, prepend=0) != 0].tobytes().split()
    counts: Counter[int] = Counter()
    room = BUCKETS - 8
    for salt, seen in ((1, Counter(words)), (2, Counter(shapes)), (3, Counter(zip(shapes, shapes[1:])))):
        for item, n in seen.items():
            counts[crc32(item if salt < 3 else b" ".join(item), salt) % room] += n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    extra = [
        1 - len(set(lines)) / max(1, len(lines)),
        1 - len(set(words)) / len(words),
        sum(len(w) > 24 for w in words) / len(words),
        min(1.0, len(words) / 40),
    ]
    where = np.fromiter(counts, np.int64, len(counts))
    share = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)) / len(words))
    return np.r_[where, room + np.arange(len(extra))], np.r_[share, extra]


@dataclass
class Ordinal:
    """Shared weights, thresholds in order, and the grades that they part."""

    weights: np.ndarray
    cuts: np.ndarray
    grades: list[float]

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.cuts[None, :], -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, rounds: int = 150, l2: float = 1e-4) -> Ordinal:
    """Maximum likelihood of the proportional-odds model by Adam, same result for the same rows.

    With fewer than two grades, every text gets the one grade there is (0 if none).
    """
    levels = sorted(set(grades.tolist()))
    if len(levels) < 2:
        return Ordinal(np.zeros(BUCKETS), np.zeros(0), levels or [0.0])
    number, cuts = len(rows), len(levels) - 1
    row = np.repeat(np.arange(number), [len(w) for w, _ in rows])
    where, value = np.concatenate([w for w, _ in rows]), np.concatenate([v for _, v in rows])
    grade = np.searchsorted(levels, grades)
    above = np.array([(grade > k).mean() for k in range(cuts)])
    start = -np.log(above / (1 - above))
    # first threshold, then logarithms of the steps between thresholds: they stay in order
    shape = np.r_[start[0], np.log(np.maximum(np.diff(start), 1e-2))]
    theta = np.r_[np.zeros(BUCKETS), shape]
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    each = np.arange(number)
    for step in range(1, rounds + 1):
        weights, shape = theta[:BUCKETS], theta[BUCKETS:]
        ordered = np.cumsum(np.r_[shape[0], np.exp(shape[1:])])
        score = np.bincount(row, weights[where] * value, number)
        sigmoid = 1 / (1 + np.exp(-np.clip(score[:, None] - ordered[None, :], -40, 40)))
        tail = np.c_[np.ones(number), sigmoid, np.zeros(number)]
        slope = tail * (1 - tail)
        likely = np.maximum(tail[each, grade] - tail[each, grade + 1], 1e-12)
        up, down = slope[each, grade] / likely, slope[each, grade + 1] / likely
        d_score = -(up - down) / number
        d_cut = np.zeros(cuts + 2)
        np.add.at(d_cut, grade, up / number)
        np.add.at(d_cut, grade + 1, -down / number)
        d_cut = d_cut[1:-1]
        d_shape = np.r_[d_cut.sum(), [d_cut[k:].sum() * np.exp(shape[k]) for k in range(1, cuts)]]
        gradient = np.r_[np.bincount(where, d_score[row] * value, BUCKETS) + l2 * weights, d_shape]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta = theta - 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    shape = theta[BUCKETS:]
    return Ordinal(theta[:BUCKETS], np.cumsum(np.r_[shape[0], np.exp(shape[1:])]), [float(x) for x in levels])


def train(
    docs: DataFrame, ratings: DataFrame, id_column: str = "doc_id", text: str = "text", grade: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> Ordinal:
    """Fit on at most `fit_rows` rated rows. Null ids, grades and texts are left out; of several
    ratings of an id the mean counts. The driver gets hashed features, at most BUCKETS a row."""
    rated = ratings.where(F.col(id_column).isNotNull() & F.col(grade).isNotNull())
    rated = rated.groupBy(id_column).agg(F.avg(grade).alias("_grade"))
    chosen = first_by_hash(rated, id_column, fit_rows, rated.count())
    own = docs.select(id_column, F.col(text).cast("string").alias("_text")).where("_text is not null")
    joined = own.join(chosen, id_column).select("_text", "_grade")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", TEXT_BYTES):
            both = [features(t.as_py()) for t in part.column("_text")]
            yield pa.RecordBatch.from_pydict(
                {
                    "where": pa.array([w.astype("<u2").tobytes() for w, _ in both], pa.binary()),
                    "value": pa.array([v.astype("<f4").tobytes() for _, v in both], pa.binary()),
                    "grade": part.column("_grade"),
                }
            )

    got = joined.mapInArrow(count, "where binary, value binary, grade double")
    # rows in a fixed order: sums of floats must not depend on which task was first
    found = sorted((bytes(r[0]), bytes(r[1]), r[2]) for r in got.collect())
    rows = [(np.frombuffer(w, "<u2").astype(np.int64), np.frombuffer(v, "<f4").astype(float)) for w, v, _ in found]
    return fit(rows, np.array([g for _, _, g in found], float))


def grade(docs: DataFrame, model: Ordinal, wanted: float | None = None, text: str = "text") -> DataFrame:
    """All rows and columns of `docs` with _expected (grade) and _tail, P(grade >= `wanted`).

    `wanted` is the highest grade if none is given. Null texts and texts without words are
    scored by the thresholds alone. An empty table gives an empty result. A new name gets
    underscores behind it should `docs` have such a column; ids may be null or repeat.
    """
    levels = np.array(model.grades)
    wanted = levels[-1] if wanted is None else wanted
    own, added = docs.columns, [free(docs, "_expected"), free(docs, "_tail")]
    schema = extended(docs, **dict.fromkeys(added, "double"))
    above = int((levels < wanted).sum())  # thresholds to pass

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, TEXT_BYTES):
            found = (features(t) for t in part.column(text).to_pylist())
            score = np.array([model.weights[w] @ v for w, v in found])
            tails = model.tails(score)
            expected = levels[0] + tails @ np.diff(levels)
            tail = tails[:, above - 1] if 0 < above <= len(model.cuts) else np.full(len(score), float(above == 0))
            columns = [part.column(c) for c in own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(expected), pa.array(tail)], names=[*own, *added])

    return docs.mapInArrow(run, schema)
