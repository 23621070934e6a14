"""Bounded-space online packing of tokenised documents into sequences of fixed length.

A task keeps a fixed number of open windows. A document's whole windows leave at once; what is
left is placed into the open window that it fills best. When it fits none, the fullest window
is topped up with the document's first tokens and leaves full, and the rest of the document is
placed in the same way. The windows still open at a task's end are merged by groups of tasks,
and the leftovers of groups again, until one group is left; a group leaves one window at most,
so that one sequence of the whole result is padded.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramlag.llm.common import slices, written

OPEN_WINDOWS = 16
#: Tasks whose leftovers are merged at once.
GROUP = 16
TEXT_BYTES = 4 << 20

FIELDS = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def encoder(path: str, ranks: str | None = None, pattern: str | None = None) -> Callable[[list[str]], list[np.ndarray]]:
    """Texts -> ids of the tokenizer in `path`, without special tokens added.

    `ranks` may name the same vocabulary in the tiktoken form, whose encoder is faster; texts with
    a special token's string go to the tokenizer itself.
    """
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]

    def plain(text: str) -> np.ndarray:
        return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")

    if not ranks:
        return lambda texts: [plain(t) for t in texts]
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={}).encode_ordinary

    def ids(texts: list[str]) -> list[np.ndarray]:
        return [plain(t) if any(s in t for s in special) else np.array(fast(t), "<u4") for t in texts]

    return ids


class Packer:
    """Open windows and the pieces that have left, as rows (key, start, length, ids, doc_tokens, sequence, offset)."""

    def __init__(self, room: int, windows: int, first: int):
        self.room, self.windows, self.next = room, windows, first
        self.open: list[list] = []  # [tokens used, pieces]
        self.out: list[tuple] = []

    def leave(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.out.append((*piece, self.next, offset))
            offset += piece[2]
        self.next += 1

    def place(self, key, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        while len(ids):
            if len(ids) >= self.room:
                self.leave([(key, start, self.room, ids[: self.room].tobytes(), doc_tokens)])
                start, ids = start + self.room, ids[self.room :]
                continue
            gaps = [self.room - used for used, _ in self.open]
            fits = [(gap, i) for i, gap in enumerate(gaps) if gap >= len(ids)]
            if not fits and len(self.open) < self.windows:
                self.open.append([0, []])
                fits = [(self.room, len(self.open) - 1)]
            gap, i = min(fits) if fits else min((gap, i) for i, gap in enumerate(gaps))
            head = ids[:gap]
            self.open[i][0] += len(head)
            self.open[i][1].append((key, start, len(head), head.tobytes(), doc_tokens))
            if self.open[i][0] == self.room:
                self.leave(self.open.pop(i)[1])
            start, ids = start + len(head), ids[len(head) :]

    def close(self) -> None:
        for _, pieces in self.open:
            self.leave(pieces)
        self.open = []


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    room: int = 1024,
    end_id: int = 0,
    windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """Pieces of documents: (id column, start, length, ids, doc_tokens, sequence_id, offset).

    Every row of `docs` gives the ids of its text, then `end_id`; a null text counts as empty,
    so it gives `end_id` alone. `ids` holds a piece's ids as little-endian unsigned 32-bit
    numbers. Rows that repeat an id (null or not) are packed each for itself. A long document
    covers several sequences. An empty table gives an empty result; other columns go unread.
    The paths must exist on the executors.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, {FIELDS}, open boolean, packer bigint"
    arrow = pa.schema(
        [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]
        + [("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_()), ("packer", pa.int64())]
    )

    def rows(pieces: list[tuple], is_open: bool, packer: int, id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*pieces)) if pieces else [[]] * 7
        arrays = [pa.array(columns[0], id_type)]
        arrays += [pa.array(c, f.type) for c, f in zip(columns[1:], arrow)]
        arrays += [pa.array([is_open] * len(pieces), pa.bool_()), pa.array([packer] * len(pieces), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["id", *arrow.names])

    def still_open(packer: Packer) -> list[tuple]:
        return [(*piece, i, k) for i, (_, pieces) in enumerate(packer.open) for k, piece in enumerate(pieces)]

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encode, packer, id_type = encoder(tokenizer, ranks, pattern), Packer(room, windows, task << 32), None
        for part in slices(batches, "text", TEXT_BYTES):
            id_type = part.column("id").type
            keys = part.column("id").to_pylist()
            for key, ids in zip(keys, encode([t or "" for t in part.column("text").to_pylist()])):
                ids = np.append(ids, np.array([end_id], "<u4"))
                packer.place(key, 0, ids, len(ids))
            yield rows(packer.out, False, task, id_type)
            packer.out = []
        if packer.open:
            yield rows(still_open(packer), True, task, id_type)

    picked = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    stage = picked.mapInArrow(first_pass, schema)
    done, level = [], 0
    while True:
        stage = written(stage, f"packed-{level}", compression="zstd")
        done.append(stage.where("not open"))
        left = stage.where("open")
        last = left.agg(F.max("packer")).first()[0]
        if last is None:
            break
        level += 1
        stage = left.withColumn("group", F.expr(f"packer div {GROUP}"))
        stage = stage.groupBy("group").applyInPandas(_merging(room, level, last < GROUP), schema)
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.select(F.col("id").alias(id_column), "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def _merging(room: int, level: int, final: bool):
    """Packs the leftovers of a group of packers into full windows; one may stay open."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["group"].iat[0])
        packer = Packer(room, 1, (level << 56) | (group << 32))
        ordered = frame.sort_values(["packer", "sequence_id", "offset"])
        ids = ordered["id"].array
        for i, start, blob, doc_tokens in zip(range(len(ids)), ordered["start"], ordered["ids"], ordered["doc_tokens"]):
            packer.place(i, int(start), np.frombuffer(blob, "<u4"), int(doc_tokens))
        if final:
            packer.close()
        left = [(*p, 0, k) for _, pieces in packer.open for k, p in enumerate(pieces)]
        names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        out = pd.DataFrame(packer.out + left, columns=names)
        out["id"] = ids.take(out["id"].to_numpy(np.int64))
        out["open"] = [False] * len(packer.out) + [True] * len(left)
        out["packer"] = group
        return out

    return merge
