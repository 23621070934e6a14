"""Filter interaction audit by forward-backward path counting over the subset lattice.

A document is reduced to the set of filters that it fails, and documents to counts per part
and set. A state of the lattice is the set of filters already applied; an edge adds one
filter, and what it removes depends on the state alone, not on the order that led there. So
n! orders need only n * 2^(n-1) edges: forward counts say in how many ways a state is reached,
backward counts in how many ways it is left to the full set, and their product weighs an edge's
removals for Shapley values. The steps of each single order are read from the same edges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramlag.llm.common import slices, utf8, written

#: Letters of the filters; bit i of a set stands for letter i. The last one needs the whole table.
FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
#: Bytes of text that are handled at once; a longer text is handled alone.
SLICE = 8 << 20
UPPER = bytes(range(65, 91))
INNER = bytes(range(0x80, 0xC0))  # bytes of a character after its first

STEPS = """
    part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint,
    unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint
"""


def failed(text: bytes, least_words: int = 200) -> int:
    """Set of the filters A to D that a text fails: few words, repeated words, capitals, symbols."""
    words = text.split()  # parts at just the six separators of the word pattern
    capitals = len(text) - len(text.translate(None, UPPER))
    points = len(text.translate(None, INNER))
    return (
        (len(words) < least_words)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 3 * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id, part, digest, fails) of every row: its whole text's SHA-256 and failed filters A to D.

    Null texts and parts are empty ones. Other columns of `docs` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            data, offsets = utf8(batch.column("text"))
            cuts = offsets.tolist()
            texts = [data[a:b] for a, b in zip(cuts, cuts[1:])]
            columns = {
                "digest": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                "fails": pa.array([failed(t) for t in texts], pa.int32()),
            }
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "part": batch.column("part"), **columns})

    taken = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text")
    )
    kind = docs.schema[key].dataType.simpleString()
    return taken.mapInArrow(run, f"id {kind}, part string, digest binary, fails int")


def tallied(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents by part and set of failed filters, E included.

    A row fails E when a row with a smaller id holds the same text; rows without an id are
    smaller than none and have none smaller. Rows are counted by (id, text) first, so copies
    under one id, and rows without id, meet as counts; then by (text, part), where the row
    of the smallest id is carried along. No group of copies is gathered.
    `labels` has id, good, toxic, once an id.
    """
    cells = rows.groupBy("digest", "part", "id").agg(F.count(F.lit(1)).alias("n"), F.min("fails").alias("fails"))
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("good", "toxic")]
    named = cells.where("id is not null").join(labels, "id", "left")
    times = [(F.col("n") * F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(c) for c in ("good", "toxic")]
    counted = named.select("digest", "part", "id", "fails", "n", *times).unionByName(
        cells.where("id is null").select("digest", "part", "id", "fails", "n", *zero)
    )
    sums = ("n", "good", "toxic")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", *sums)))
    unnamed = [F.sum(F.when(F.col("id").isNull(), F.col(c))).alias(f"{c}_unnamed") for c in sums]
    texts = counted.groupBy("digest", "part").agg(
        F.min("fails").alias("fails"), first.alias("first"), *[F.sum(c).alias(c) for c in sums], *unnamed
    )
    smallest = texts.groupBy("digest").agg(F.min("first.id").alias("smallest"))
    texts = texts.join(smallest, "digest")
    passing = [
        (
            F.when(F.col("first.id") == F.col("smallest"), F.col("first")[c]).otherwise(0)
            + F.coalesce(f"{c}_unnamed", F.lit(0))
        ).alias(c)
        for c in sums
    ]
    texts = texts.select("part", "fails", F.struct(*sums).alias("all"), F.struct(*passing).alias("pass"))
    rest = F.struct(*[(F.col("all")[c] - F.col("pass")[c]).alias(c) for c in sums])
    copies = F.col("fails") + F.lit(1 << FILTERS.index("E"))
    both = F.array(
        F.struct(F.col("fails").alias("fails"), F.col("pass").alias("of")), F.struct(copies.alias("fails"), rest.alias("of"))
    )
    return (
        texts.select("part", F.inline(both))
        .select("part", "fails", "of.*")
        .groupBy("part", "fails")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def paths(n: int) -> tuple[list[int], list[int]]:
    """Numbers of orders that reach each state from the empty set, and that lead on to the full set."""
    states = 1 << n
    forward, backward = [0] * states, [0] * states
    forward[0] = backward[states - 1] = 1
    for state in range(states):
        for f in range(n):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in reversed(range(states)):
        for f in range(n):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


class Lattice:
    """Edges of the subset lattice of n filters, with what each does to a part's counts by failed set."""

    def __init__(self, n: int):
        self.n = n
        self.edges = [(s, f) for s in range(1 << n) for f in range(n) if not s >> f & 1]
        self.number = {edge: i for i, edge in enumerate(self.edges)}
        forward, backward = paths(n)
        self.weights = [forward[s] * backward[s | 1 << f] for s, f in self.edges]

    def _sums(self, counts: np.ndarray, chosen) -> np.ndarray:
        return np.array([sum(int(counts[m]) for m in range(1 << self.n) if chosen(m, s, f)) for s, f in self.edges])

    def measured(self, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
        """Measures of every edge (state, filter), in whole numbers."""
        removes = lambda m, s, f: not m & s and m >> f & 1
        edge = {
            "kept": self._sums(n, lambda m, s, f: not m & (s | 1 << f)),
            "removed": self._sums(n, removes),
            "redundant": self._sums(n, lambda m, s, f: m & s and m >> f & 1),
            "unique_fails": self._sums(n, lambda m, s, f: m == 1 << f),
            "good_lost": self._sums(good, removes),
            "toxic_lost": self._sums(toxic, removes),
        }
        of_filter = [0] * self.n
        for (_, f), weight, removed in zip(self.edges, self.weights, edge["removed"].tolist()):
            of_filter[f] += weight * removed
        edge["shapley"] = np.array([of_filter[f] for _, f in self.edges])
        return edge


def audit(tally: DataFrame, letters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counts (part, fails, n, good, toxic).

    All orders are listed, so this is for a handful of filters. A part comes with one row per
    failed set, however many documents it has.
    """
    lattice = Lattice(len(letters))
    orders = ["".join(o) for o in permutations(letters)]
    walked = [[] for _ in orders]
    for path, order in zip(walked, orders):
        state = 0
        for letter in order:
            f = letters.index(letter)
            path.append(lattice.number[state, f])
            state |= 1 << f
    edges = np.array(walked).ravel()
    names = [order for order in orders for _ in letters]
    steps = np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(orders))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.zeros((3, 1 << lattice.n), np.int64)
                for cell in row["cells"]:
                    counts[:, cell["fails"]] = cell["n"], cell["good"], cell["toxic"]
                found = {k: pa.array(v[edges], pa.int64()) for k, v in lattice.measured(*counts).items()}
                own = {"part": [row["part"]] * len(names), "filter_order": names, "step": steps}
                yield pa.RecordBatch.from_pydict(own | found)

    cells = F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells")
    return tally.groupBy("part").agg(cells).mapInArrow(run, STEPS)


def interactions(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """The audit of filters A to E on all of `docs`.

    `labels` has the key, quality and toxic; several rows of an id count as good or toxic when
    one of them is, rows without id are ignored. Texts are judged once; the table of judgements,
    without texts, is written below the checkpoint folder. Empty tables give no rows.
    """
    rows = written(judged(docs, key, text, part), "judged")
    marks = [F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))]
    marked = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(*marks)
    return audit(tallied(rows, marked))
