"""SimHash near-duplicates through vantage-point trees.

Fingerprints are partitioned by their Hamming distance to vantage points. The upper trees are
fitted on a bounded sample and sent to the tasks. There is one for each of `radius` + 1 blocks of
bits, which looks at the bits of its block alone: a pair within `radius` agrees in all bits of some
block, so no sphere of that block's tree parts it, and each tree deals every distinct fingerprint
to just one shard. Wide radii, whose blocks would be too short, have one tree of all bits, which
also deals a fingerprint to each shard that a ball around it reaches across a boundary. Shards
that are too large for a task are dealt again, each by such a tree fitted on a sample of its own,
until none is. A shard goes on with trees of all bits, down to leaves that are compared in full.
The triangle bound makes this exact: of a pair within `radius`, either both lie inside a sphere, or
both lie outside a sphere that is smaller by `radius`, so each pair meets in some leaf.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramlag.llm.common import components, first_by_hash, free, words_of, written

SEED = 42
#: Fingerprints that the upper tree is fitted on, at most.
SAMPLE = 65_536
#: Distinct fingerprints a shard is aimed at; and the most shards of one tree, which bounds the tree sent to tasks.
SHARD, MAX_SHARDS = 4_096, 4_096
#: Points of a shard beyond which it is dealt again.
LARGE = 1 << 18
#: Tasks that the shards are spread over, at most.
MOST_TASKS = 1 << 16
#: Points of a shard that are compared in full.
LEAF = 1_024
#: Bits of a block that has an upper tree, at least.
SHORTEST = 8
#: Fingerprints that a task deals at once; arrow's batches are shorter than there may be shards.
AT_ONCE = 1 << 16

ALL = (1 << 64) - 1
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits; a bit is set if it is set in over half the shingles' XXH64. No words: zero."""
    words = [w.lower() for w in words_of(text)]  # of bytes: A-Z only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begins = (ends - [len(w) + 1 for w in words]).tolist()
        ends = (ends - 1).tolist()
        hashes = [digest(joined[i:j], SEED) for i, j in zip(begins, ends[shingle - 1 :])]
    seen = np.array(hashes, np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8)
    places = seen.astype(np.int64) + np.arange(8) * 256
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(counts.ravel() * 2 > len(hashes), bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """(id, same, fp): one row per row of `docs`; same is a hash of the text, fp the fingerprint as a
    signed number, zero for a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(prints, pa.int64())], ["id", "same", "fp"])

    kind = docs.schema[id_column].dataType.simpleString()
    own = F.col(text).cast("string")
    picked = docs.select(F.col(id_column).alias("id"), F.xxhash64(own).alias("same"), own.alias("text"))
    return picked.mapInArrow(run, f"id {kind}, same bigint, fp bigint")


def _split(points: np.ndarray, radius: int, seed: int) -> tuple[int, int] | None:
    """Vantage point and radius of the sphere that parts `points` best for the copies it costs."""
    rng = np.random.default_rng(seed)
    best, chosen = 0.0, None
    for vantage in rng.choice(points, size=min(8, len(points)), replace=False):
        share = np.cumsum(np.bincount(np.bitwise_count(points ^ vantage), minlength=65)) / len(points)
        before = np.concatenate([np.zeros(radius), share])[: len(share)]
        band = share - before
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = -(share * np.log2(share) + (1 - share) * np.log2(1 - share))
        gain[(share < 0.08) | (share > 0.92) | (before < 0.04) | ~np.isfinite(gain)] = 0  # both parts shrink, copies included
        gain = gain / (np.log2(1 + band) + 0.02)
        if gain.max() > best:
            best, chosen = gain.max(), (int(vantage), int(gain.argmax()))
    return chosen if best > 1.2 else None


def _parts(points: np.ndarray, vantage: int, sphere: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    far = np.bitwise_count(points ^ np.uint64(vantage))
    return far <= sphere, far > sphere - radius


def build(sample: np.ndarray, shards: int, radius: int) -> list[tuple[int, int, int, int]]:
    """Upper tree as rows (vantage, sphere, inner, outer); negative children are shards."""
    size = max(4, len(sample) // max(1, shards))
    nodes: list[tuple[int, int, int, int]] = []
    made = 0

    def grow(points: np.ndarray) -> int:
        nonlocal made
        found = _split(points, radius, len(nodes)) if len(points) > size else None
        if found is None:
            made += 1
            return -made
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        inner, outer = _parts(points, *found, radius)
        nodes[at] = (*found, grow(points[inner]), grow(points[outer]))
        return at

    root = grow(sample)
    return nodes if root >= 0 else []


def route(
    points: np.ndarray, nodes: list[tuple[int, int, int, int]], radius: int, mask: int = ALL
) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, its points), a point near a boundary in several; the tree looks at the bits of `mask`."""
    if not nodes:
        yield 1, points
        return
    left = [(0, points)]
    while left:
        at, own = left.pop()
        if at < 0:
            yield -at, own
        elif len(own):
            vantage, sphere, inner, outer = nodes[at]
            near, far = _parts(own & np.uint64(mask), vantage, sphere, radius)
            left += [(inner, own[near]), (outer, own[far])]


def blocks(radius: int) -> list[int]:
    """Masks that part the 64 bits: two values that differ in at most `radius` bits agree in all of some block.

    All bits at once where the blocks would be too short.
    """
    if 64 // (radius + 1) < SHORTEST:
        return [ALL]
    return [sum(1 << int(b) for b in own) for own in np.array_split(np.arange(64), radius + 1)]


def forest(sample: np.ndarray, shards: int, radius: int) -> list[tuple[int, int, list[tuple[int, int, int, int]]]]:
    """Upper trees as (mask, radius, nodes). Within a block the radius is zero: spheres part no pair that agrees there."""
    if shards < 2:
        return [(ALL, radius, [])]
    masks = blocks(radius)
    own = radius if masks == [ALL] else 0
    return [(mask, own, build(sample & np.uint64(mask), shards, own)) for mask in masks]


def deal(points: np.ndarray, trees: list[tuple[int, int, list[tuple[int, int, int, int]]]]) -> tuple[np.ndarray, np.ndarray]:
    """(shard, point) of every tree, whose shards have numbers of their own."""
    found = [
        (part * len(trees) + k, own)
        for k, (mask, radius, nodes) in enumerate(trees)
        for part, own in route(points, nodes, radius, mask)
    ]
    numbers = np.repeat(np.array([n for n, _ in found], np.int64), [len(own) for _, own in found])
    return numbers, np.concatenate([np.zeros(0, np.uint64), *(own for _, own in found)])


def flooded(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): forest of the links of at most `radius` among points that no sphere splits.

    Each point meets only those that nothing has reached yet. Where spheres do not split, most
    points lie near one another, and soon none is left to reach.
    """
    unseen, border, ends = np.arange(len(points)), np.zeros(0, np.int64), []
    while len(unseen):
        if not len(border):
            border, unseen = unseen[:1], unseen[1:]
            continue
        some = max(1, (1 << 17) // len(unseen))
        own, border = border[:some], border[some:]
        close = np.bitwise_count(points[own, None] ^ points[None, unseen]) <= radius
        met = close.any(axis=0)
        if met.any():
            ends.append((own[close[:, met].argmax(axis=0)], unseen[met]))
            border, unseen = np.concatenate([border, unseen[met]]), unseen[~met]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *(e[k] for e in ends)]) for k in (0, 1))


def linked(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest over distinct `points` that connects just what links of at most `radius` connect."""
    order = np.sort(points)
    root = np.arange(len(order))

    def find(i: np.ndarray) -> np.ndarray:
        while True:
            up = root[i]
            if (up == i).all():
                return i
            i = up

    def join(i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            i, j = find(i), find(j)
            apart = i != j
            i, j = i[apart], j[apart]
            if len(i):
                pairs = np.unique(np.stack([np.minimum(i, j), np.maximum(i, j)]), axis=1)
                i, j = pairs
                root[j] = i  # one of several wins, the others come round again

    left = [np.arange(len(order))]
    while left:
        own = left.pop()
        found = _split(order[own], radius, len(own)) if len(own) > LEAF else None
        if found is not None:
            near, far = _parts(order[own], *found, radius)
            if near.sum() < len(own) and far.sum() < len(own):
                left += [own[near], own[far]]
                continue
        if len(own) > LEAF:
            a, b = flooded(order[own], radius)
            join(own[a], own[b])
            continue
        mine, rows = order[own], max(1, (1 << 17) // len(own))
        for k in range(0, len(own), rows):
            i, j = np.nonzero(np.bitwise_count(mine[k : k + rows, None] ^ mine[None, k:]) <= radius)
            later = i < j
            join(own[i[later] + k], own[j[later] + k])
    top = find(np.arange(len(order)))
    moved = np.flatnonzero(top != np.arange(len(order)))
    return order[moved], order[top[moved]]


def parted(large: DataFrame, radius: int) -> DataFrame:
    """(shard, fp, whole) of `large` (shard, points, fp): each shard dealt by a tree fitted on some of its points.

    The points of a shard come in pieces, each with the shard's tree, so that no task holds a
    large shard. A shard that no sphere splits stays `whole`.
    """

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        points, aimed = frame["fp"].to_numpy(np.int64).view(np.uint64), -(-int(frame["points"].iloc[0]) // SHARD)
        tree = json.dumps(build(points, min(MAX_SHARDS, aimed), radius))
        return pd.DataFrame({"shard": frame["shard"].iloc[:1], "points": frame["points"].iloc[:1], "tree": [tree]})

    def deal(frame: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame({"shard": [], "fp": [], "whole": []}).astype({"shard": np.int64, "fp": np.int64, "whole": bool})
        points, shard = frame["fp"].to_numpy(np.int64).view(np.uint64), int(frame["shard"].iloc[0])
        nodes = json.loads(trees["tree"].iloc[0])
        if not nodes:
            return pd.DataFrame({"shard": shard, "fp": points.view(np.int64), "whole": True})
        # two shards that got one name would be compared together, which loses nothing
        name = lambda part: np.uint64(xxhash.xxh64_intdigest(f"{shard}/{part}")).view(np.int64)
        parts = [(name(part), own) for part, own in route(points, nodes, radius) if len(own)]
        names = np.repeat([n for n, _ in parts], [len(own) for _, own in parts])
        return pd.DataFrame({"shard": names, "fp": np.concatenate([own for _, own in parts]).view(np.int64), "whole": False})

    # about twice SAMPLE points of each shard, picked by a hash
    share = F.lit(2.0 * SAMPLE) / F.col("points")
    some = large.where(F.xxhash64("fp").cast("double") <= share * F.lit(2.0**64) - F.lit(2.0**63))
    trees = some.groupBy("shard").applyInPandas(fit, "shard bigint, points bigint, tree string")
    pieces = F.ceil(F.col("points") / LARGE)
    trees = trees.select("shard", "tree", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)).alias("piece"))
    dealt = large.select("shard", "fp", F.pmod(F.xxhash64(F.lit(1), "fp"), pieces).alias("piece"))
    both = dealt.groupBy("shard", "piece").cogroup(trees.groupBy("shard", "piece"))
    return both.applyInPandas(deal, "shard bigint, fp bigint, whole boolean")


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): edges between values of column fp, a forest per shard, whose components are those
    of all links at `radius` or fewer differing bits."""
    number = distinct.count()
    shards = max(1, -(-number // SHARD))
    by_hash = first_by_hash(distinct.select("fp"), "fp", SAMPLE, number)
    sample = np.array([r.fp for r in by_hash.collect()] or [0], np.int64).view(np.uint64)
    trees = forest(sample, min(MAX_SHARDS, shards), radius)

    def dealt_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, number = [], 0
        for frame in chain(frames, [None]):
            if frame is not None:
                waiting.append(frame["fp"].to_numpy(np.int64))
                number += len(frame)
            if waiting and (frame is None or number >= AT_ONCE):
                shard, own = deal(np.concatenate(waiting).view(np.uint64), trees)
                yield pd.DataFrame({"shard": shard, "fp": own.view(np.int64)})
                waiting, number = [], 0

    def within(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = linked(frame["fp"].to_numpy(np.int64).view(np.uint64), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    left = written(distinct.select("fp").mapInPandas(dealt_out, "shard bigint, fp bigint"), "shards")
    done = []
    while True:
        sizes = left.groupBy("shard").agg(F.count(F.lit(1)).alias("points"))
        large = written(sizes.where(F.col("points") > LARGE), "large")
        if large.isEmpty():
            done.append(left)
            break
        done.append(left.join(large, "shard", "left_anti"))
        again = written(parted(left.join(large, "shard"), radius), "parted")
        done.append(again.where("whole").select("shard", "fp"))
        left = again.where("not whole").select("shard", "fp")
    dealt = reduce(DataFrame.unionByName, done).repartition(min(shards, MOST_TASKS), "shard")
    return dealt.groupBy("shard").applyInPandas(within, "a bigint, b bigint")


def simhash_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 5, radius: int = 3
) -> DataFrame:
    """(id column, fp, component_id, same): one row per row of `docs`; same is a hash of the text.

    `component_id` is the smallest id reachable through links of at most `radius` differing
    bits. Null or empty texts and texts without words have fingerprint zero and link like any
    other. Rows that repeat an id stay apart in the result and meet in one component only if
    their texts link. A null id never names a component unless all its ids are null. An empty
    table gives an empty result; other columns are not looked at.

    Equal fingerprints collapse to one row before any comparison, so copies cost nothing.
    """
    prints = written(fingerprints(docs, id_column, text, shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    classes = components(links(distinct, radius))
    named = distinct.join(classes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = written(named, "named")
    least = written(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    of = written(named.join(least, "root").select("fp", "component_id"), "components")
    return prints.join(of, "fp").select(F.col("id").alias(id_column), "fp", "component_id", "same")


def hex_digits(fp: str = "fp"):
    """A signed 64-bit column as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 5, radius: int = 3
) -> DataFrame:
    """Rows of `docs` whose id names their component: one document of each group, columns as given.

    Of equal texts under one id a single row stays; other rows that share an id are judged each
    by its text. Rows with a null id are judged by nothing and stay. Columns of any name may be there.
    """
    same, stays, copy = (free(docs, f"_{c}") for c in ("same", "stays", "copy"))
    groups = simhash_groups(docs, id_column, text, shingle, radius).toDF("id", "fp", "component_id", "same")
    stay = groups.where("id = component_id").select(F.col("id").alias(id_column), F.col("same").alias(same)).distinct()
    marked = docs.withColumn(same, F.xxhash64(F.col(text).cast("string")))
    joined = marked.join(stay.withColumn(stays, F.lit(True)), [id_column, same], "left")
    ranked = joined.withColumn(copy, F.row_number().over(Window.partitionBy(id_column, same).orderBy(F.lit(0))))
    return ranked.where(F.col(id_column).isNull() | F.col(stays) & (F.col(copy) == 1)).select(*docs.columns)
