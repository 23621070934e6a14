"""NN-descent against brute force."""

import numpy as np
from conftest_llm import union_find

from tramlag.llm import nn_descent


def expected(rows, threshold):
    valid = [i for i, (n, v) in enumerate(rows) if n is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for a in valid:
        for b in valid:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], np.float32).astype(float), np.array(rows[b][1], np.float32).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links.append((a, b))
    root = union_find(len(rows), links)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[root[i]] = min(least.get(root[i], name), name)
    out = []
    for i, (name, _) in enumerate(rows):
        component = least.get(root[i]) if i in valid else name
        out.append((repr(name), sum(i in x for x in links), repr(component), name is None or component == name))
    return sorted(out)


def found(df):
    return sorted((repr(r.vec_id), r.n_links, repr(r.component_id), r.kept) for r in df.collect())


def test_equals_brute_force_with_a_dense_group(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 40)  # smaller than the dense group
    monkeypatch.setattr(nn_descent, "LEAF", 30)
    monkeypatch.setattr(nn_descent, "COUNTED", 40)
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=16) for _ in range(250)]
    centre = rng.normal(size=16)
    vectors += [centre + 0.12 * rng.normal(size=16) for _ in range(90)]  # far more links than a list holds
    vectors += [v + 0.02 * rng.normal(size=16) for v in vectors[:40]]
    vectors += [vectors[3], vectors[3], vectors[7] * 2]
    order = rng.permutation(len(vectors))
    rows = [(int(i), [float(np.float32(x)) for x in vectors[k]]) for i, k in enumerate(order)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    want, got = expected(rows, 0.95), found(nn_descent.near_duplicates(df))
    assert len(got) == len(want)
    right = sum(a == b for a, b in zip(got, want))
    assert right >= 0.97 * len(want)
    assert sum(x[1] for x in got) <= sum(x[1] for x in want)  # none below the threshold


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.01]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
        (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [0.0, 1.0]), (11, [0.0, 1.0]), (None, [1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    extra = df.selectExpr("*", "1 as label", "2 as node", "3 as e")
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in nn_descent.near_duplicates(extra).collect()}
    assert {(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (10, 0, 10, True), (11, 1, 11, True)} <= got
    assert {(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9)} <= got
    assert nn_descent.near_duplicates(df.limit(0)).count() == 0


def links_of(graph):
    return {(r.a, r.b) for r in nn_descent.edges_of(graph, 0.95).where("a <> b").collect()}


def nodes_of(spark, vectors):
    rows = [(i, 1, [float(x) for x in v], np.array(v, "<f4").tobytes(), len(v)) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "node bigint, copies bigint, e array<float>, vec binary, dim int")


def test_large_leaf_is_parted_by_nearness(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 32)
    rng = np.random.default_rng(1)
    half = rng.normal(size=(200, 16))
    nodes = nodes_of(spark, np.concatenate([half, half + 0.002 * rng.normal(size=half.shape)]))
    graph = nn_descent.merged(nn_descent.first_graph(nodes, "<f4", [(16, [])], 0.95, 2), 0.95, 2)
    links = links_of(graph)
    assert sum((i, i + 200) in links for i in range(200)) >= 190
    same = nodes_of(spark, [[1.0, 0.0]] * 100)  # no direction parts them
    graph = nn_descent.merged(nn_descent.first_graph(same, "<f4", [(2, [])], 0.95, 2), 0.95, 2)
    assert min(len(r.ids) for r in graph.collect()) >= 8 * nn_descent.NEIGHBOURS


def test_all_neighbours_of_a_hub_are_compared(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 32)
    rng = np.random.default_rng(2)
    half = rng.normal(size=(100, 16))
    nodes = nodes_of(spark, np.concatenate([half, half + 0.002 * rng.normal(size=half.shape)]))
    hub = np.array([0], "<i8").tobytes(), np.array([-1.0]).tobytes()
    graph = spark.createDataFrame([(i, *(hub if i else (b"", b"")), -2.0, b"") for i in range(200)], nn_descent.LIST)
    pairs = {(i, i + 100) for i in range(100)}
    for dealt in (4096, 50):
        monkeypatch.setattr(nn_descent, "DEALT", dealt, raising=False)
        offered = nn_descent.descend(nodes, "<f4", graph, 0.95, 2)
        assert pairs <= links_of(nn_descent.merged(offered, 0.95, 2)), dealt


def test_trees_grow_until_the_audit_is_content(spark, monkeypatch):
    recalls = [0.5, 0.6, 0.7, 0.8, 0.99]
    monkeypatch.setattr(nn_descent, "audit", lambda *_: recalls.pop(0))
    df = spark.createDataFrame([(i, [1.0, i / 100]) for i in range(5)], "vec_id bigint, embedding array<float>")
    nn_descent.near_duplicates(df)
    assert not recalls


def test_dense_groups_that_touch_by_one_link_are_one(spark):
    """The link's ends have more than a full list of closer links, and smaller ids in their own group."""
    rng = np.random.default_rng(6)
    degrees = [22.0 * (i % 2) + (0.1 * rng.random() if i < 40 else 2.6 - 5.2 * (i % 2)) for i in range(42)]
    rows = [(i, [float(np.float32(x)) for x in (np.cos(np.radians(d)), np.sin(np.radians(d)))]) for i, d in enumerate(degrees)]
    want = expected(rows, 0.95)
    assert {x[2] for x in want} == {"0"} and want[-1][1] >= 20
    assert found(nn_descent.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))) == want


def test_lengths_near_the_bounds_of_doubles():
    rng = np.random.default_rng(9)
    rows = rng.normal(size=(4, 8))
    for scale in (1.0, 1e-200, 1e200, 2.0**-1040):
        blobs = [(x * scale).astype("<f8").tobytes() for x in rows]
        got = nn_descent.unit(blobs, "<f8")
        assert np.allclose(got @ got.T, nn_descent.unit([x.astype("<f8").tobytes() for x in rows], "<f8") @ got.T, atol=1e-6)
        assert np.allclose(np.linalg.norm(got, axis=1), 1)
