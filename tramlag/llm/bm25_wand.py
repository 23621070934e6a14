"""Exact top-k search by BM25 over an inverted index, with block-max WAND in every shard.

A shard is the index of a bounded piece of the table. Its postings lie in blocks that carry the
largest term frequency and the smallest document length, from which the largest score in the
block follows once the global statistics are known. Queries run against every shard; WAND skips
documents, and blocks, that cannot reach the shard's k-th best score. As all shards use the same
global statistics, the best k of all shards' best k are exact.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramlag.llm.common import slices, written

K1, B = 1.2, 0.75
#: Text of a shard, postings of a block, queries run at once.
SHARD_BYTES, BLOCK, QUERIES = 4 << 20, 64, 256
#: Terms: runs of anything but blanks, controls and ASCII punctuation, in lower case.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
NO_ID = -(2**63)


def terms_of(text: str | None) -> list[str]:
    return TERM.findall(text.lower()) if text else []


def index(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(shard, term, size, docs, words, rows, ids, tfs, lengths, most_tf, least_length): a row per term of a shard.

    `rows` counts the shard's rows in the order of their ids, which is the order of postings; the
    last two are a block's bounds. A shard's terms come sorted, so that stored statistics tell
    which row groups may hold a term. A row without a term has the shard's number of documents and
    of words.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 24
        for part in slices(batches, "text", SHARD_BYTES):
            ids = np.array([NO_ID if i is None else i for i in part.column("id").to_pylist()], np.int64)
            order = np.argsort(ids, kind="stable")
            texts = part.column("text").to_pylist()
            rows = [terms_of(texts[i]) for i in order]
            ids, number = ids[order], len(rows)
            lengths = np.fromiter(map(len, rows), np.int64, number)
            coded = pa.array([w for r in rows for w in r], pa.string()).dictionary_encode()
            del rows, texts  # words take most of the memory
            terms = coded.dictionary
            sorted_terms = pc.sort_indices(terms)
            rank = np.empty(len(terms), np.int64)
            rank[sorted_terms.to_numpy()] = np.arange(len(terms))
            pairs = rank[coded.indices.to_numpy()] * number + np.repeat(np.arange(number), lengths)
            pairs, tfs = np.unique(pairs, return_counts=True)
            term, row = np.divmod(pairs, max(1, number))
            starts = np.flatnonzero(np.diff(term, prepend=-1))
            ends = np.r_[starts[1:], len(term)] if len(starts) else starts
            blocks = -(-(ends - starts) // BLOCK)
            upto = np.cumsum(blocks)
            first = np.repeat(starts, blocks) + BLOCK * (np.arange(blocks.sum()) - np.repeat(upto - blocks, blocks))
            own_lengths = lengths[row]
            posted = [(row, "<u4"), (ids[row], "<i8"), (tfs, "<u4"), (own_lengths, "<u4")]
            bounds = [np.maximum.reduceat(tfs, first), np.minimum.reduceat(own_lengths, first)] if len(first) else [first, first]
            columns = [pa.array(np.full(len(starts), shard)), terms.take(sorted_terms), pa.array(ends - starts)]
            columns += [pa.nulls(len(starts), pa.int64())] * 2
            columns += [_cut(values, kind, ends) for values, kind in posted] + [_cut(values, "<u4", upto) for values in bounds]
            yield pa.RecordBatch.from_arrays(columns, _INDEX)
            totals = {n: pa.nulls(1, f.type) for n, f in zip(_INDEX, columns)}
            totals |= {"shard": pa.array([shard]), "docs": pa.array([number]), "words": pa.array([int(lengths.sum())])}
            yield pa.RecordBatch.from_pydict(totals)
            shard += 1

    picked = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(build, _SCHEMA)


def _cut(values: np.ndarray, kind: str, ends: np.ndarray) -> pa.Array:
    """The values as binary cells, one up to each of `ends`."""
    blob = values.astype(kind)
    offsets = (np.r_[0, ends] * blob.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(blob)])


_INDEX = ["shard", "term", "size", "docs", "words", "rows", "ids", "tfs", "lengths", "most_tf", "least_length"]
_SCHEMA = (
    "shard bigint, term string, size bigint, docs bigint, words bigint, "
    "rows binary, ids binary, tfs binary, lengths binary, most_tf binary, least_length binary"
)


def postings_of(indexed: DataFrame, wanted: set[str]) -> DataFrame:
    """Rows of the index with `wanted` terms, which are those of a block of queries; no other row leaves the scan."""
    terms = indexed.sparkSession.createDataFrame([(t,) for t in sorted(wanted)], "term string")
    return indexed.drop("docs", "words").join(F.broadcast(terms), "term", "left_semi")


class Postings:
    """A term's postings in a shard with their scores and the largest score of each block."""

    __slots__ = ("rows", "ids", "scores", "lasts", "bounds", "bound")

    def __init__(self, idf: float, average: float, rows, ids, tfs, lengths, most_tf, least_length):
        def score(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
            return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))

        places = np.frombuffer(rows, "<u4").astype(np.int64)
        self.rows, self.ids = places.tolist(), np.frombuffer(ids, "<i8")
        self.scores = score(np.frombuffer(tfs, "<u4").astype(float), np.frombuffer(lengths, "<u4").astype(float)).tolist()
        self.lasts = places[np.minimum(np.arange(BLOCK, len(places) + BLOCK, BLOCK), len(places)) - 1].tolist()
        bounds = score(np.frombuffer(most_tf, "<u4").astype(float), np.frombuffer(least_length, "<u4").astype(float))
        self.bounds = (bounds * (1 + 1e-9)).tolist()  # sums in another order must not exceed a bound
        self.bound = max(self.bounds)


def wand(lists: list[tuple[int, Postings]], k: int) -> list[tuple[float, int]]:
    """Best k of (score, id), rows rising among equals. `lists`: how often the query has a term, its postings."""
    lists = [(n, p) for n, p in lists if p.rows]
    at = [0] * len(lists)
    best: list[tuple[float, int, int]] = []  # heap of (score, -row, id)
    least = 0.0
    alive = list(range(len(lists)))
    while alive:
        alive.sort(key=lambda i: lists[i][1].rows[at[i]])
        total, pivot = 0.0, None
        for place, i in enumerate(alive):
            total += lists[i][0] * lists[i][1].bound
            if total > least or len(best) < k:
                pivot = place
                break
        if pivot is None:
            break
        doc = lists[alive[pivot]][1].rows[at[alive[pivot]]]
        while pivot + 1 < len(alive) and lists[alive[pivot + 1]][1].rows[at[alive[pivot + 1]]] == doc:
            pivot += 1
        total, until = 0.0, None
        for i in alive[: pivot + 1]:
            n, p = lists[i]
            block = bisect_left(p.lasts, doc)
            if block < len(p.lasts):
                total += n * p.bounds[block]
                until = p.lasts[block] if until is None else min(until, p.lasts[block])
        if total <= least and len(best) == k:
            # no document up to the end of these blocks can do it, unless a further list joins in
            target = doc + 1 if until is None else until + 1
            if pivot + 1 < len(alive):
                target = min(target, lists[alive[pivot + 1]][1].rows[at[alive[pivot + 1]]])
            target = max(target, doc + 1)
            for i in alive[: pivot + 1]:
                at[i] = bisect_left(lists[i][1].rows, target, at[i])
        elif lists[alive[0]][1].rows[at[alive[0]]] == doc:
            name = int(lists[alive[0]][1].ids[at[alive[0]]])
            score = 0.0
            for i in sorted(alive[: pivot + 1]):
                n, p = lists[i]
                score += n * p.scores[at[i]]
                at[i] += 1
            if len(best) < k:
                heapq.heappush(best, (score, -doc, name))
            elif score > least:
                heapq.heapreplace(best, (score, -doc, name))
            least = best[0][0] if len(best) == k else 0.0
        else:
            for i in alive[:pivot]:
                at[i] = bisect_left(lists[i][1].rows, doc, at[i])
        alive = [i for i in alive if at[i] < len(lists[i][1].rows)]
    return [(s, name) for s, _, name in sorted(best, key=lambda x: (-x[0], -x[1]))]


def search(
    docs: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "doc_id", text: str = "text",
    query_id: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """(query id column, rank, id column, score): for each query the k best documents of all.

    Documents without a query's terms are no result, so a query may have fewer than k rows, or
    none if it has no terms or is null; a null query id is left out. Equal scores rank by id, null
    first. Rows that repeat an id, or have none, are documents of their own. Queries are taken in
    blocks of QUERIES; the driver holds one block, its terms and their document counts. Empty
    tables give an empty result; other columns go unread.
    """
    indexed = written(index(docs, id_column, text), "index", compression="zstd")
    number, words = indexed.where("term is null").agg(F.sum("docs"), F.sum("words")).first()
    average = max(1e-9, (words or 0) / max(1, number or 0))
    kinds = f"query {queries.schema[query_id].dataType.simpleString()}, id bigint, score double"
    found = None
    asked = queries.select(query_id, F.col(query_text).cast("string")).where(F.col(query_id).isNotNull())
    block: list[tuple] = []

    def run(block: list[tuple]) -> DataFrame:
        terms = [(q, Counter(terms_of(t))) for q, t in block]
        wanted = {t for _, own in terms for t in own}
        postings = written(postings_of(indexed, wanted), "postings")
        counts = {r.term: r.n for r in postings.groupBy("term").agg(F.sum("size").alias("n")).collect()}
        idf = {t: log(1 + (number - n + 0.5) / (n + 0.5)) for t, n in counts.items()}

        def shard(frame: pd.DataFrame) -> pd.DataFrame:
            columns = (frame[n] for n in ("rows", "ids", "tfs", "lengths", "most_tf", "least_length"))
            own = {t: Postings(idf[t], average, *blobs) for t, *blobs in zip(frame["term"], *columns)}
            rows = []
            for query, counted in terms:
                lists = [(n, own[t]) for t, n in sorted(counted.items()) if t in own]
                rows += [(query, doc, score) for score, doc in wand(lists, k)]
            return pd.DataFrame(rows, columns=["query", "id", "score"])

        return postings.groupBy("shard").applyInPandas(shard, kinds)

    for row in asked.toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == QUERIES:
            found = run(block) if found is None else found.unionByName(run(block))
            block = []
    if block or found is None:
        found = run(block) if found is None else found.unionByName(run(block))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    own = F.when(F.col("id") != NO_ID, F.col("id")).alias(id_column)
    return ranked.select(F.col("query").alias(query_id), "rank", own, "score")
