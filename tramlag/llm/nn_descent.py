"""Embedding near-dedup by NN-descent.

Equal vectors collapse to one node. Random-projection trees, fitted on a bounded sample and carried
on within the tasks until a leaf holds BLOCK nodes at most, give a first neighbour graph; rounds of
NN-descent improve it: every node receives the vectors of its neighbours in both directions, compares
all of them with one another, and offers each the closest it did not know. Lists that are full of
links are enlarged. Links at the threshold give components; within a component every pair is compared
in blocks, so that counts are exact however many links a node has. Trees and rounds are added until
an audit against brute force on a bounded sample finds enough of the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramlag.llm.common import components, first_by_hash, written

#: Neighbours a list starts with, and how much a list that is full of links grows.
NEIGHBOURS, GROWTH = 8, 2
#: Vectors that trees are fitted on at most, nodes of a leaf, nodes compared at once and of a leaf at most.
SAMPLE, LEAF, BLOCK = 16_384, 192, 512
#: Neighbours of a hub that a task compares with as many others; directions tried to part a leaf.
DEALT, DIRECTIONS = 4_096, 8
#: Members of a component that a task compares with as many others.
COUNTED = 256
TREES, ROUNDS = 6, 3
#: Nodes of the audit, the mean share of a node's links that must be known, and by how much these exceed the threshold.
AUDITED, RECALL, SURE = 1_024, 0.98, 1e-12


def unit(blobs: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    rows = np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype(np.float64)
    # by a power of two, which changes no digit: squares neither vanish nor overflow
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def nodes_of(vectors: DataFrame, id_column: str, embedding: str) -> tuple[DataFrame, str]:
    """(node, copies, e, vec, dim): distinct valid vectors, named by their smallest id; numpy kind of vec."""
    element = vectors.schema[embedding].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    e = F.col(embedding)
    zero = F.forall(e, lambda x: x == 0)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    valid = vectors.where(F.col(id_column).isNotNull() & e.isNotNull() & (F.size(e) > 0) & finite & ~zero)
    distinct = valid.groupBy(e.alias("e")).agg(F.min(id_column).alias("node"), F.count("*").alias("copies"))

    def blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = [np.array(x, kind).tobytes() for x in batch.column(2).to_pylist()]
            dim = pa.array([len(v) // np.dtype(kind).itemsize for v in vec], pa.int32())
            arrays = [*batch.columns, pa.array(vec, pa.binary()), dim]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "copies", "e", "vec", "dim"])

    made = distinct.select(F.col("node").cast("bigint"), "copies", "e")
    kinds = f"node bigint, copies bigint, e {distinct.schema['e'].dataType.simpleString()}, vec binary, dim int"
    return made.mapInArrow(blobs, kinds), kind


def groups(batches: Iterator[pa.RecordBatch], keys: int, most: int) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows that agree in the first `keys` columns, at most `most` rows at a time."""
    key, held = None, []

    def out() -> tuple[tuple, dict[str, list]]:
        return key, dict(zip(names, map(list, zip(*held))))

    for batch in batches:
        names = batch.schema.names[keys:]
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[:keys] != key or len(held) >= most:
                if held:
                    yield out()
                    held = []
                key = row[:keys]
            held.append(row[keys:])
    if held:
        yield out()


def by_key(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def trees_of(sample: np.ndarray, leaf: int, number: int, seed: int) -> list[list[tuple]]:
    """Random-projection trees as lists of (direction, cut, left, right); negative children are leaves."""

    def tree(rng: np.random.Generator) -> list[tuple]:
        nodes: list[tuple] = []
        leaves = 0

        def grow(rows: np.ndarray) -> int:
            nonlocal leaves
            if len(rows) > leaf:
                a, b = rows[rng.choice(len(rows), 2, replace=False)]
                along = rows @ (a - b)
                cut = float(np.median(along))
                right = along > cut
                if right.any():
                    at = len(nodes)
                    nodes.append(())
                    nodes[at] = ((a - b).astype(np.float32), cut, grow(rows[~right]), grow(rows[right]))
                    return at
            leaves += 1
            return -leaves

        grow(sample)
        return nodes

    return [tree(np.random.default_rng(seed + i)) for i in range(number)]


LIST = "node bigint, ids binary, sims binary, least double, anchors binary"
_LIST = pa.schema([("node", pa.int64()), ("ids", pa.binary()), ("sims", pa.binary()), ("least", pa.float64()), ("anchors", pa.binary())])


def rows_of(node: np.ndarray, ids: np.ndarray, sims: np.ndarray, names: np.ndarray, anchors: list[bytes]) -> list[list]:
    """Columns of lists, a row a name; its entries are those where `node`, in the order of `names`, is that name.

    `least` is the similarity that an offer must exceed: of the last entry, if the list is full.
    """
    ends = np.searchsorted(node, names, side="right")
    begins = np.searchsorted(node, names, side="left")
    ids, sims = ids.astype("<i8").tobytes(), sims.astype("<f8").tobytes()
    cut = lambda blob: [blob[8 * b : 8 * e] for b, e in zip(begins.tolist(), ends.tolist())]
    parts = cut(sims)
    least = [np.frombuffer(x, "<f8").min() if len(x) >= 8 * NEIGHBOURS else -2.0 for x in parts]
    return [names.tolist(), cut(ids), parts, least, anchors]


def batched(found: Iterator[list[list]], most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Columns of many groups as batches of about `most` rows."""
    held: list[list] = [[] for _ in _LIST]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(held, _LIST)], schema=_LIST)

    for columns in found:
        for own, more in zip(held, columns):
            own += more
        if len(held[0]) >= most:
            yield out()
            held = [[] for _ in _LIST]
    if held[0]:
        yield out()


def parts(vectors: np.ndarray, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Rows of a leaf, halved along fresh directions to BLOCK at most. What no direction parts stays together."""
    left = [np.arange(len(vectors))]
    while left:
        own = left.pop()
        for _ in range(DIRECTIONS if len(own) > BLOCK else 0):
            a, b = vectors[rng.choice(own, 2, replace=False)]
            along = vectors[own] @ (a - b)
            right = along > np.median(along)
            if right.any():
                left += [own[~right], own[right]]
                break
        else:
            yield own


def offers(ids: np.ndarray, near: np.ndarray, known: list[np.ndarray] | None, least: np.ndarray | None, threshold: float):
    """(row, column, similarity) of what rows are offered of the columns, which are named by rising `ids`.

    At first each is offered its closest; later what beats its list and is not in it.
    """
    if known is not None:
        row, flat = np.repeat(np.arange(len(near)), [len(x) for x in known]), np.concatenate(known)
        place = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
        same = ids[place] == flat
        near[row[same], place[same]] = -2
        near[near <= least[:, None]] = -2
    most = GROWTH * NEIGHBOURS
    if len(ids) > most:
        cut = -np.partition(-near, most - 1, axis=1)[:, most - 1]
        near[near < cut[:, None]] = -2
    if known is None and len(ids) > NEIGHBOURS:
        cut = -np.partition(-near, NEIGHBOURS - 1, axis=1)[:, NEIGHBOURS - 1]
        near[near < np.minimum(cut, threshold)[:, None]] = -2
    i, j = np.nonzero(near > -2)
    return i, j, near[i, j]


def join(root: np.ndarray, rows: np.ndarray, others: np.ndarray, linked: np.ndarray) -> None:
    """Joins components along the links of some rows; `root` has the first row of each row's component."""
    i, j = np.nonzero(linked)
    a, b = root[rows[i]], root[others[j]]
    while (apart := a != b).any():
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root[:] = root[root]
        a, b = root[low], root[high]


def compared(own: dict[str, list], kind: str, threshold: float, between: bool = False) -> Iterator[list[list]]:
    """Lists of what the nodes of a group have for one another; every pair is compared, BLOCK by BLOCK nodes at once.

    `between` asks for pairs of a first and a second node only. The anchor is the smallest id that
    a node reaches by the links of the group: full lists hold a node's nearest links only, and the
    anchors of all groups join whatever any pair of compared nodes joins, with an edge a node.
    """
    ids = np.array(own["node"], np.int64)
    order = np.argsort(ids)
    ids, vectors = ids[order], unit(own["vec"], kind)[order]
    known = [np.frombuffer(own["ids"][i], np.int64) for i in order] if "ids" in own else None
    least = np.array(own["least"])[order] if "ids" in own else None
    sides = [(np.arange(len(ids)),) * 2]
    if between:
        second = np.array(own["second"])[order]
        sides = [(np.flatnonzero(~second), np.flatnonzero(second)), (np.flatnonzero(second), np.flatnonzero(~second))]
    cut = lambda x: [x[k : k + BLOCK] for k in range(0, len(x), BLOCK)]
    root = np.arange(len(ids))
    for rows, others in ((r, side[1]) for side in sides for r in cut(side[0])):
        found = []
        for some in cut(others):
            near = vectors[rows] @ vectors[some].T
            near[ids[rows][:, None] == ids[some]] = -2
            join(root, rows, some, near >= threshold)
            listed = None if known is None else [known[r] for r in rows]
            i, j, sims = offers(ids[some], near, listed, None if least is None else least[rows], threshold)
            found.append((i, ids[some][j], sims))
        i, j, sims = map(np.concatenate, zip(*found)) if len(found) != 1 else found[0]
        if len(found) > 1:
            order = np.argsort(i, kind="stable")
            i, j, sims = i[order], j[order], sims[order]
        whole = len(rows) == len(ids)  # or else more links are to come
        anchors = [ids[a].tobytes() if whole and a != r else b"" for a, r in zip(root[rows], rows)]
        names = np.full(len(rows), known is None)
        names[i] = True
        names |= np.array([a != b"" for a in anchors], bool)
        yield rows_of(ids[rows][i], j, sims, ids[rows][names], [a for a, n in zip(anchors, names) if n])
    if between or len(ids) > BLOCK:
        far = np.flatnonzero(root != np.arange(len(ids)))
        yield rows_of(ids[:0], ids[:0], np.zeros(0), ids[far], [ids[a].tobytes() for a in root[far]])


def first_graph(nodes: DataFrame, kind: str, trees: list[tuple], threshold: float, partitions: int, seed: int = 0) -> DataFrame:
    """Offers from the leaves of the trees. In a task, a leaf beyond BLOCK nodes is parted as its tree would go on."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs, dims = batch.column("vec").to_pylist(), np.array(batch.column("dim").to_pylist())
            out: list[tuple] = []
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                rows = unit([blobs[i] for i in at], kind)
                for number, (width, tree) in enumerate(trees):
                    left = [(0 if tree else -1, np.arange(len(at)))] if width == dim else [(-1, np.arange(len(at)))] * (number == 0)
                    while left:
                        place, own = left.pop()
                        if place < 0:
                            out += [(number, int(dim), -place, int(at[i])) for i in own]
                        elif len(own):
                            direction, cut, low, high = tree[place]
                            right = rows[own] @ direction.astype(np.float64) > cut
                            left += [(low, own[~right]), (high, own[right])]
            if not out:
                continue
            number, dim, place, index = zip(*out)
            taken = pa.array(index, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()), pa.array(dim, pa.int32()), pa.array(place, pa.int32())]
                + [batch.column(c).take(taken) for c in ("node", "vec")],
                ["tree", "dim", "leaf", "node", "vec"],
            )

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def leaves() -> Iterator[dict[str, list]]:
            for key, own in groups(batches, 3, 1 << 62):
                if len(own["node"]) <= BLOCK:
                    yield own
                    continue
                order = np.argsort(own["node"])
                vectors = unit([own["vec"][i] for i in order], kind)
                for part in parts(vectors, np.random.default_rng([seed, *key])):
                    yield {name: [column[i] for i in order[part]] for name, column in own.items()}

        yield from batched(lists for own in leaves() if len(own["node"]) > 1 for lists in compared(own, kind, threshold))

    dealt = nodes.select("node", "vec", "dim").mapInArrow(deal, "tree int, dim int, leaf int, node bigint, vec binary")
    return by_key(dealt, ["tree", "dim", "leaf"], partitions).mapInArrow(within, LIST)


def merged(offered: DataFrame, threshold: float, partitions: int) -> DataFrame:
    """One list a node: the best of all offers. A list that is full of links is enlarged."""

    def best(part: pa.Table) -> list[list]:
        names, sizes = part.column("node").to_numpy(), [len(b) // 8 for b in part.column("ids").to_pylist()]
        node = np.repeat(names, sizes)
        ids = np.frombuffer(b"".join(part.column("ids").to_pylist()), "<i8")
        sims = np.frombuffer(b"".join(part.column("sims").to_pylist()), "<f8")
        order = np.lexsort((ids, -sims, node))
        node, ids, sims = node[order], ids[order], sims[order]
        # equal similarities of a pair come from products in another order: apart by rounding only
        order = np.lexsort((ids, node))
        twice = np.zeros(len(ids), bool)
        twice[order[1:]] = (ids[order[1:]] == ids[order[:-1]]) & (node[order[1:]] == node[order[:-1]])
        node, ids, sims = node[~twice], ids[~twice], sims[~twice]
        rank = np.arange(len(node)) - np.searchsorted(node, node, side="left")
        keep = (rank < NEIGHBOURS) | (sims >= threshold) & (rank < GROWTH * NEIGHBOURS)
        fresh = np.flatnonzero(np.diff(names, prepend=names[0] - 1))
        blobs = part.column("anchors").to_pylist()
        owner, anchors = np.repeat(names, [len(b) // 8 for b in blobs]), np.frombuffer(b"".join(blobs), "<i8")
        order = np.lexsort((anchors, owner))
        owner, anchors = owner[order], anchors[order]
        once = np.ones(len(owner), bool)
        once[1:] = (owner[1:] != owner[:-1]) | (anchors[1:] != anchors[:-1])
        owner, anchors = owner[once], anchors[once]
        begins, ends = (np.searchsorted(owner, names[fresh], side=x).tolist() for x in ("left", "right"))
        anchors = [anchors[b:e].tobytes() for b, e in zip(begins, ends)]
        return rows_of(node[keep], ids[keep], sims[keep], names[fresh], anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("node").to_numpy()
            begin = int(np.searchsorted(names, names[-1]))  # the last node may go on in the next batch
            if begin or held and held[-1].column("node")[-1].as_py() != names[0]:
                done = [*held, *([batch.slice(0, begin)] if begin else [])]
                if done:
                    yield best(pa.Table.from_batches(done))
                held = [batch.slice(begin)]
            else:
                held.append(batch)
        if held:
            yield best(pa.Table.from_batches(held))

    return by_key(offered, ["node"], partitions).mapInArrow(lambda batches: batched(run(batches)), LIST)


def edges_of(graph: DataFrame, threshold: float | None = None) -> DataFrame:
    """(a, b) of the lists' entries; with a threshold, of the links among them and the anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for node, ids, sims, _, anchors in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, np.int64)
                if threshold is not None:
                    ids = np.append(ids[np.frombuffer(sims, np.float64) >= threshold], np.frombuffer(anchors, np.int64))
                a.append(np.full(len(ids), node))
                b.append(ids)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], ["a", "b"])

    return graph.mapInArrow(run, "a bigint, b bigint")


def descend(nodes: DataFrame, kind: str, graph: DataFrame, threshold: float, partitions: int) -> DataFrame:
    """One round: offers between the neighbours, in both directions, of each node.

    The neighbours of a hub are dealt out in pairs of blocks.
    """
    forward = edges_of(graph)
    both = forward.unionByName(forward.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = both.unionByName(graph.select(F.col("node").alias("a"), F.col("node").alias("b"))).distinct()
    both = written(both, "both")
    hubs = both.groupBy("a").count().where(F.col("count") > DEALT)
    hubs = hubs.select("a", F.ceil(F.col("count") / DEALT).cast("int").alias("blocks"))
    placed = both.join(hubs, "a", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    both = placed.select(
        "a", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).alias("second"), "b",
    )
    members = nodes.select(F.col("node").alias("b"), "vec", "dim").join(graph.select(F.col("node").alias("b"), "ids", "least"), "b")
    sent = both.join(written(members, "members"), "b").select("a", "dim", "low", "high", "second", F.col("b").alias("node"), "vec", "ids", "least")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((key, own) for key, own in groups(batches, 4, 1 << 62) if len(own["node"]) > 1)
        yield from batched(lists for (_, _, low, high), own in found for lists in compared(own, kind, threshold, low != high))

    return by_key(sent, ["a", "dim", "low", "high"], partitions).mapInArrow(within, LIST)


def recounted(nodes: DataFrame, kind: str, classes: DataFrame, threshold: float) -> DataFrame:
    """(node, root, linked): copies of other nodes that it links with, all pairs of a component compared.

    A component of many nodes is dealt out in pairs of blocks; a pair of blocks gives a count a node.
    """
    sizes = classes.groupBy("root").count()
    blocks = sizes.select("root", F.ceil(F.col("count") / COUNTED).cast("int").alias("blocks"))
    placed = classes.join(blocks, "root").join(nodes.drop("e"), "node")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = placed.select(
        "root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).alias("second"), "node", "copies", "vec",
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), own in groups(batches, 3, 1 << 62):
            vectors, copies = unit(own["vec"], kind), np.array(own["copies"], np.float64)
            second = np.array(own["second"]) if low != high else np.zeros(len(copies), bool)
            linked = np.zeros(len(copies))
            if low == high:
                near = vectors @ vectors.T >= threshold
                np.fill_diagonal(near, False)
                linked = near @ copies
            else:
                near = vectors[~second] @ vectors[second].T >= threshold
                linked[~second], linked[second] = near @ copies[second], near.T @ copies[~second]
            yield pa.RecordBatch.from_arrays([pa.array(own["node"], pa.int64()), pa.array(linked.astype(np.int64))], ["node", "linked"])

    counted = dealt.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    return counted.mapInArrow(count, "node bigint, linked bigint").groupBy("node").agg(F.sum("linked").alias("linked"))


def audit(nodes: DataFrame, number: int, kind: str, counts: DataFrame, threshold: float) -> float:
    """Recall: the mean share of its links that is known of a node with links, over AUDITED nodes and
    by brute force against all nodes. Every node weighs the same, whether it has one link or many.
    Links that only rounding puts at the threshold are not asked for."""
    chosen = first_by_hash(nodes.select("node", "vec", "dim"), "node", AUDITED, number, salt=1).collect()
    names = np.array([r.node for r in chosen], np.int64)
    probes = {}
    for dim in {r.dim for r in chosen}:
        at = [i for i, r in enumerate(chosen) if r.dim == dim]
        probes[dim] = (at, unit([bytes(chosen[i].vec) for i in at], kind))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), np.int64)
        for (dim,), own in groups(batches, 1, 2048):
            if dim in probes:
                at, rows = probes[dim]
                near = rows @ unit(own["vec"], kind).T >= threshold + SURE
                near &= names[at][:, None] != np.array(own["node"])[None, :]
                total[at] += near @ np.array(own["copies"], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total)], ["node", "linked"])

    there = nodes.select("dim", "node", "copies", "vec").mapInArrow(brute, "node bigint, linked bigint")
    there = there.groupBy("node").agg(F.sum("linked").alias("there")).where("there > 0")
    known = there.join(counts, "node", "left")
    return known.agg(F.avg(F.least(F.coalesce("linked", F.lit(0)) / F.col("there"), F.lit(1.0)))).first()[0]


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """(id column, n_links, component_id, kept): one row per row of `vectors`.

    Vectors link at a cosine, in double precision, of `threshold` or more and equal length.
    `component_id` is the smallest id reachable by links, `kept` says whether it is the row's
    own. Vectors that are null, empty, zero or hold null or non-finite components, and rows with
    a null id, link with nothing and are components of their own. Rows that repeat an id count
    as vectors of their own in n_links. Equal vectors link with one another. An empty table
    gives an empty result; other columns are not looked at.
    """
    spark = vectors.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    nodes, kind = nodes_of(vectors, id_column, embedding)
    nodes = written(nodes, "nodes")
    number = nodes.count()
    sample = first_by_hash(nodes.select("node", "vec", "dim"), "node", SAMPLE, number).collect()
    dims = sorted({r.dim for r in sample})
    graph, counts, classes, seed = None, None, None, 0
    while True:
        trees = []
        for dim in dims:
            own = unit([bytes(r.vec) for r in sample if r.dim == dim], kind)
            leaf = max(4, round(LEAF * len(sample) / max(1, number)))
            trees += [(dim, t) for t in trees_of(own, leaf, TREES, seed)]
        seed += TREES
        offered = first_graph(nodes, kind, trees, threshold, partitions, seed)
        graph = written(merged(offered if graph is None else graph.unionByName(offered), threshold, partitions), "graph")
        before = 0
        for _ in range(ROUNDS):
            offered = descend(nodes, kind, graph, threshold, partitions)
            graph = written(merged(graph.unionByName(offered), threshold, partitions), "graph")
            links = edges_of(graph, threshold).where("a <> b").count()
            if links <= before * 1.01:
                break
            before = links
        classes = components(edges_of(graph, threshold).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        counts = written(recounted(nodes, kind, classes, threshold), "counts")
        recall = audit(nodes, number, kind, counts, threshold)
        if recall is None or recall >= RECALL:
            break
    of = nodes.select("node", "copies", "e").join(classes, "node", "left").join(counts, "node", "left")
    of = of.select("node", "copies", "e", F.coalesce("root", "node").alias("root"), F.coalesce("linked", F.lit(0)).alias("linked"))
    of = written(of, "linked")
    least = of.groupBy("root").agg(F.min("node").alias("component_id"))
    links = (F.col("linked") + F.col("copies") - 1).alias("n_links")
    # back from nodes to rows, by equal vectors
    of = written(of.join(least, "root").select(F.col("e").alias("_e"), links, "component_id"), "by_vector")
    e = F.col(embedding)
    rows = vectors.select(F.col(id_column), e.alias("_e"))
    joined = rows.join(of, "_e", "left")
    component = F.coalesce("component_id", F.col(id_column))
    return joined.select(
        id_column,
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col(id_column), F.lit(True)).alias("kept"),
    )
