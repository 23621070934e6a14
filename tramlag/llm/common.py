"""Helpers shared by the operators: written tables, arrow batches, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramlag.session import shared_folder

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """`df` as a table in the shared folder: cuts lineage, survives the loss of executors."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def extended(df: DataFrame, **kinds: str) -> T.StructType:
    """Schema of `df` with more columns."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, T.DataType.fromDDL(k)) for n, k in kinds.items())])


def free(df: DataFrame, name: str) -> str:
    """`name`, with underscores behind it until no column of `df` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """Bytes of a text column, one row behind the other, and the offsets of the rows; null is empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = data.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if data else b""
    return held, offsets - offsets[0]


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` as UTF-8; null has none. bytes.split() parts at just these six."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def map_rows(df: DataFrame, function: Callable[[list[list]], dict[str, list]], schema: str) -> DataFrame:
    """mapInArrow over column lists: `function` gets the columns of a batch, returns columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(function([c.to_pylist() for c in batch.columns]))

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts in `column` hold about `most` bytes; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            yield batch.slice(begin, end - begin)


def first_by_hash(df: DataFrame, column: str, most: int, number: int, salt: int = 0) -> DataFrame:
    """At most `most` rows of `df`, which has about `number`: those first by a hash of `column`.

    Rows whose hash is far behind are dropped where they are read, so that the one task which
    orders the rest gets about twice as many rows as it keeps, however many tasks send them.
    """
    place = F.xxhash64(F.lit(salt), F.col(column))
    share = 2 * most / max(1, number)
    near = df.where(place <= F.lit(int(-(2**63) + share * 2**64))) if share < 1 else df
    return near.orderBy(place, column).limit(most)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table: (node, root), nodes without an edge left out.

    Each round every node points to the neighbour (or itself) that is first by a hash of its
    id; edges are contracted along these pointers until none is left. The hash order makes a
    long chain of ascending ids shrink by a constant factor a round. Minima are combined
    before the shuffle, and the joins read written tables, so that adaptive execution can
    split the rows of one hot node. Nothing but a count of edges reaches the driver.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    left = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(rank("b")).alias("near"))
        step = near.select(F.col("a").alias("node"), F.least(F.col("near"), rank("a"))["id"].alias("to"))
        step = written(step, "hooks")
        if labels is None:
            labels = step.withColumnRenamed("to", "root")
        else:
            moved = labels.join(step.withColumnRenamed("node", "root"), "root", "left")
            labels = moved.select("node", F.coalesce("to", "root").alias("root"))
        labels = written(labels, "labels")
        contracted = (
            left.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        left = written(contracted.distinct(), "edges")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
