"""SimHash over vantage-point shards and substring dedup, against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from conftest_llm import union_find

from tramlag.llm import simhash_vp, substring_cm
from tramlag.llm.common import components


def slow_fingerprint(text, shingle):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = raw.split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, shingle, radius):
    prints = [slow_fingerprint(t, shingle) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    root = union_find(len(rows), near)
    least = {}
    for i, (name, _) in enumerate(rows):
        least.setdefault(root[i], []).append(name)
    best = {r: min((n for n in names if n is not None), default=None) for r, names in least.items()}
    return sorted((repr(rows[i][0]), prints[i], repr(best[root[i]])) for i in range(len(rows)))


def as_rows(groups):
    return sorted((repr(r[0]), r[1] % 2**64, repr(r[2])) for r in groups.collect())


def test_groups_equal_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert as_rows(simhash_vp.simhash_groups(documents, shingle=3)) == slow_groups(rows, 3, 3)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert as_rows(simhash_vp.simhash_groups(odd, shingle=5)) == slow_groups(rows, 5, 3)
    assert simhash_vp.simhash_groups(none).count() == 0


def test_one_of_each_group_stays(odd):
    kept = simhash_vp.one_of_each(odd)
    assert kept.columns == odd.columns
    got = sorted(repr((r.doc_id, (r.text or "")[:8])) for r in kept.collect())
    # 2 repeats 1, 4 and 5 repeat 3, 7 is 6 with one more word; another text under id 2 has its own group
    assert got == sorted(map(repr, [(1, "one two "), (2, "another "), (3, ""), (6, "w0 w1 w2"), (None, "no id at")]))


def test_shards_lose_no_pair():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**64, 300, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(6000)]
    points = np.unique(np.concatenate([centres[rng.integers(0, 300, 6000)] ^ np.array(flips, np.uint64), centres]))
    place = {int(p): i for i, p in enumerate(points)}
    near = [(i, j) for i in range(len(points)) for j in np.flatnonzero(np.bitwise_count(points[i] ^ points[:i]) <= 3)]
    for shards in (1, 7, 60):
        nodes = simhash_vp.build(rng.choice(points, 2000, replace=False), shards, 3)
        edges = []
        for _, own in simhash_vp.route(points, nodes, 3):
            a, b = simhash_vp.linked(own, 3)
            edges += [(place[int(x)], place[int(y)]) for x, y in zip(a, b)]
        assert union_find(len(points), edges) == union_find(len(points), near)


def clustered(rng, centres, number, most):
    """Points within `most` bits of some of the centres, each once."""
    centres = rng.integers(0, 2**64, centres, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, most + 1), replace=False)) for _ in range(number)]
    return np.unique(centres[rng.integers(0, len(centres), number)] ^ np.array(flips, np.uint64))


@pytest.mark.parametrize("radius", [0, 1, 3, 5, 7, 8, 20])
def test_trees_of_blocks_lose_no_pair(radius):
    rng = np.random.default_rng(radius)
    points = clustered(rng, 80, 1500, radius + 2)
    place = {int(p): i for i, p in enumerate(points)}
    near = [(i, j) for i in range(len(points)) for j in np.flatnonzero(np.bitwise_count(points[i] ^ points[:i]) <= radius)]
    for shards in (1, 9, 60):
        trees = simhash_vp.forest(rng.choice(points, 700, replace=False), shards, radius)
        numbers, own = simhash_vp.deal(points, trees)
        if radius < 8:
            assert len(own) == len(trees) * len(points)
            assert shards == 1 or len(np.unique(numbers)) > shards
        edges = []
        for shard in np.unique(numbers):
            a, b = simhash_vp.linked(own[numbers == shard], radius)
            edges += [(place[int(x)], place[int(y)]) for x, y in zip(a, b)]
        assert union_find(len(points), edges) == union_find(len(points), near)


def test_copies_across_boundaries_do_not_grow(spark, monkeypatch):
    """Each fingerprint is dealt once for each block of bits, however many shards there are."""
    monkeypatch.setattr(simhash_vp, "SHARD", 32)
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.integers(0, 2**64, 3000, dtype=np.uint64), clustered(rng, 100, 1000, 4)])
    distinct = spark.createDataFrame([(int(p),) for p in np.unique(points).view(np.int64)], "fp bigint")
    dealt, whole = [], simhash_vp.written

    def written(df, purpose, **options):
        found = whole(df, purpose, **options)
        if purpose == "shards":
            dealt.append((found.count(), found.select("shard").distinct().count()))
        return found

    monkeypatch.setattr(simhash_vp, "written", written)
    simhash_vp.links(distinct, 3).count()
    assert dealt[0][0] == 4 * distinct.count()
    assert dealt[0][1] > 100


def test_large_shards_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(simhash_vp, "SHARD", 16)
    monkeypatch.setattr(simhash_vp, "MAX_SHARDS", 3)  # of a tree, so that shards stay large at first
    monkeypatch.setattr(simhash_vp, "LARGE", 150)
    rng = np.random.default_rng(8)
    centres = rng.integers(0, 2**64, 60, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(600)]
    ball = centres[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))[:, None] ^ (np.uint64(1) << np.arange(4, dtype=np.uint64))
    points = np.unique(np.concatenate([centres[rng.integers(0, 60, 600)] ^ np.array(flips, np.uint64), ball.ravel()]))
    place = {int(p): i for i, p in enumerate(points.view(np.int64))}
    near = [(i, j) for i in range(len(points)) for j in np.flatnonzero(np.bitwise_count(points[i] ^ points[:i]) <= 3)]
    seen = []
    whole = simhash_vp.parted
    monkeypatch.setattr(simhash_vp, "parted", lambda *a: seen.append(1) or whole(*a))
    distinct = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp bigint")
    edges = [(place[r.a], place[r.b]) for r in simhash_vp.links(distinct, 3).collect()]
    assert union_find(len(points), edges) == union_find(len(points), near)
    assert seen


def test_a_cluster_that_no_sphere_splits():
    """All values within three bits of a centre are one shard at any fit, and one component."""
    rng = np.random.default_rng(5)
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    two = (bits[:, None] ^ bits[None, :]).ravel()
    three = (two[:, None] ^ bits[None, :]).ravel()
    centre = np.uint64(0x0123456789ABCDEF)
    ball = np.unique(np.concatenate([two, bits, three])) ^ centre
    assert len(ball) == 43_745 and simhash_vp.build(ball, 50, 3) == []
    a, _ = simhash_vp.linked(ball, 3)
    assert len(np.unique(a)) == len(ball) - 1
    some = np.unique(np.concatenate([rng.choice(ball, 1500, replace=False), rng.integers(0, 2**64, 500, dtype=np.uint64)]))
    near = [(i, j) for i in range(len(some)) for j in np.flatnonzero(np.bitwise_count(some[i] ^ some[:i]) <= 3)]
    i, j = simhash_vp.flooded(some, 3)
    assert (np.bitwise_count(some[i] ^ some[j]) <= 3).all()
    assert union_find(len(some), zip(i, j)) == union_find(len(some), near)


def test_columns_of_clashing_names(odd):
    clash = odd.selectExpr(
        "*", "1 as _same", "2 as _stays", "3 as _copy", "4 as fp", "5 as component_id", "6 as _doc", "7 as _sig",
        "8 as begins", "9 as _begins", "10 as _ends", "11 as _kept", "12 as count",
    )
    plain = sorted(repr(tuple(r)[:4]) for r in simhash_vp.one_of_each(odd).collect())
    kept = simhash_vp.one_of_each(clash)
    assert kept.columns == clash.columns and sorted(repr(tuple(r)[:4]) for r in kept.collect()) == plain
    cut = substring_cm.remove_repeats(clash, window=5)
    assert cut.columns == [*clash.columns, "_n_words", "_n_removed", "_kept_"]
    got = sorted(repr((r.doc_id, r._n_removed, r._kept_)) for r in cut.collect())
    want = substring_cm.remove_repeats(odd, window=5).collect()
    assert got == sorted(repr((r.doc_id, r._n_removed, r._kept)) for r in want)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    got = components(spark.createDataFrame(chain + star + [(5000, 5000)], "a bigint, b bigint")).collect()
    roots = {}
    for node, root in got:
        roots.setdefault(root, set()).add(node)
    assert sorted(map(len, roots.values())) == [50, 61]


def slow_removal(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (name, _), own in zip(rows, words):
        for k in range(len(own) - window + 1):
            key = tuple(own[k : k + window])
            if name is not None:
                first[key] = min(first.get(key, name), name)
    out = []
    for (name, _), own in zip(rows, words):
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            if name is not None and first[tuple(own[k : k + window])] < name:
                gone[k : k + window] = [True] * window
        kept = b" ".join(w for w, g in zip(own, gone) if not g)
        out.append((repr(name), len(own), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def slow_removal_texts(rows, window):
    """The texts of rows in order of rising ids, the words removed that a smaller id's window covers."""
    seen, out = set(), []
    for _, text in rows:
        words = (text or "").encode().split()
        keys = [tuple(words[k : k + window]) for k in range(len(words) - window + 1)]
        gone = {k + i for k, key in enumerate(keys) if key in seen for i in range(window)}
        seen.update(keys)
        out.append(b" ".join(w for i, w in enumerate(words) if i not in gone).decode() if gone else text)
    return out


def removal(docs, window):
    rows = substring_cm.remove_repeats(docs, window=window).collect()
    return sorted((repr(r.doc_id), r._n_words, r._n_removed, hashlib.sha256(r._kept.encode()).hexdigest()) for r in rows)


def test_removal_equals_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert removal(documents, 13) == slow_removal(rows, 13)


def test_removal_of_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for window in (1, 5, 13):
        assert removal(odd, window) == slow_removal(rows, window)
    assert substring_cm.remove_repeats(odd).columns == [*odd.columns, "_n_words", "_n_removed", "_kept"]
    assert substring_cm.remove_repeats(none).count() == 0


def test_removal_over_small_chunks(spark, monkeypatch):
    random.seed(1)
    vocabulary = [f"v{i}" for i in range(40)]
    rows = [(i, " ".join(random.choices(vocabulary, k=random.randint(0, 60)))) for i in range(120)]
    monkeypatch.setattr(substring_cm, "CHUNK", 200)
    monkeypatch.setattr(substring_cm, "TEXT_BYTES", 500)
    # sketches of many segments, as full as large ones
    monkeypatch.setattr(substring_cm, "LEAST_CELLS", 4)
    monkeypatch.setattr(substring_cm, "SEGMENT", 5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert removal(docs, 3) == slow_removal(rows, 3)


def test_sketch_codes_round_trip():
    cells = np.sort(np.random.default_rng(0).integers(0, 1 << 22, 5000)).astype(np.int64)
    for some in (cells, cells[:1], cells[:0], np.repeat(cells[-3:], 2), np.array([0]), np.array([0, 0, 1, (1 << 26) - 1])):
        assert substring_cm.unpack(substring_cm.pack(some)).tolist() == some.tolist()
    numbers = np.arange(7, dtype=np.int64) * 10**12
    assert (substring_cm._concat([substring_cm.planes(numbers)], np.int64) == numbers).all()
