"""Features, filters and likeness against plain loops; edits and order; odd rows."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramlag.llm import improbable_digest as digest
from tramlag.llm import registry

SF = "/root/testdata/sf0.001"


def levels_by_hand(text):
    data = text.ljust(digest.WINDOW, b"\0")
    found = []
    for i in range(len(data) - digest.WINDOW + 1):
        counts = Counter(data[i : i + digest.WINDOW]).values()
        total = sum(round(n * np.log2(n) * 2**20) for n in counts)
        most = round(digest.WINDOW * np.log2(digest.WINDOW) * 2**20)
        found.append(max(0, digest.LEVELS - math.ceil(total * (digest.LEVELS / most))))
    return found


def digest_by_hand(text, ranks):
    """(number of features, filters as sets of bits) with one loop per rule."""
    if not text:
        return 0, []
    rank = [ranks[v] for v in levels_by_hand(text)]
    wins = [0] * len(rank)
    for i in range(len(rank)):
        near = range(i, min(i + digest.NEIGHBOURS, len(rank)))
        wins[min(near, key=lambda j: (rank[j], j))] += 1
    at = [i for i, w in enumerate(wins) if w >= digest.WINS] or [rank.index(min(rank))]
    data, seen = text.ljust(digest.WINDOW, b"\0"), []
    for i in at:
        if (feature := data[i : i + digest.WINDOW]) not in seen:
            seen.append(feature)
    filters = []
    for k, feature in enumerate(seen):
        if k % digest.FULL == 0:
            filters.append(set())
        value = int(digest.hashes(np.frombuffer(feature, np.uint8)[None, :])[0])
        filters[-1] |= {value >> 11 * i & 2047 for i in range(digest.HASHES)}
    return len(seen), filters


def likeness_by_hand(a, b):
    if a == b:
        return 1.0
    (n, own), (_, other) = sorted((a, b), key=lambda d: d[0])
    if not n:
        return 0.0
    total, m = 0, digest.BITS
    strict = digest.SIGMAS**2 + 2 * math.log(len(own) * len(other))
    for k, x in enumerate(own):
        scores = [0]
        for y in other:
            chance, most, common = len(x) * len(y) / m, min(len(x), len(y)), len(x & y)
            if (common - chance) ** 2 > strict * chance * (1 - len(x) / m) * (1 - len(y) / m):
                scores.append((common - chance) / (most - chance))
        total += max(scores) * min(digest.FULL, n - digest.FULL * k)
    return min(1.0, total / n)


def read(made):
    n = int.from_bytes(made[:4], "big")
    rows = np.unpackbits(np.frombuffer(made, np.uint8, offset=4)).reshape(-1, digest.BITS)
    return n, [set(np.flatnonzero(r).tolist()) for r in rows]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh ", k=rng.randint(2, 9))) for _ in range(400)]
    made = [" ".join(rng.choices(words, k=k)).encode() for k in (1, 2, 5, 9, 20, 60, 300, 2500)]
    odd = [b"", b"x", b"a" * 500, b"ab" * 300, "é日𝄞 ".encode() * 40, bytes(range(32, 127)) * 3, made[5] * 3]
    return made + odd + [made[6][:1000] + made[7][:900], made[7] + made[6]]


@pytest.fixture(scope="module")
def ranks():
    order = np.random.default_rng(3).permutation(digest.LEVELS + 1)
    return order.astype(np.int64)


def test_fingerprints_by_hand(texts, ranks):
    made = digest.digests(texts, ranks)
    assert [read(d) for d in made] == [digest_by_hand(t, ranks) for t in texts]
    assert [digest.digests([t], ranks)[0] for t in texts] == made
    for a in made[::2]:
        for b in made:
            want = likeness_by_hand(read(a), read(b))
            assert digest.likeness(a, b) == pytest.approx(want, abs=1e-4)
            assert digest.likeness(b, a) == pytest.approx(digest.likeness(a, b), abs=1e-4)


def test_long_texts_are_judged_in_pieces(texts, ranks, monkeypatch):
    whole = digest.digests(texts, ranks)
    monkeypatch.setattr(digest, "SLICE", 700)
    monkeypatch.setattr(digest, "CHUNK", 333)
    monkeypatch.setattr(digest, "BLOCK", 3)
    assert digest.digests(texts, ranks) == whole
    assert digest.likeness(whole[7], whole[-1]) > 0.8


def test_rarity_counts_every_window(documents):
    counts = Counter()
    for row in documents.select("text").limit(20).collect():
        counts.update(levels_by_hand(row.text.encode()))
    ranks = digest.rarity(documents.limit(20))
    levels = sorted(range(digest.LEVELS + 1), key=lambda v: (v < digest.WEAK, counts[v], v))
    assert ranks.argsort().tolist() == levels


def edits_by_hand(rows):
    """rows: (id, text) in order; -> (id, n, sha256 of the edited text, next text)."""
    found = []
    for i, (name, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        found.append((name, len(text), hashlib.sha256(edited.encode()).hexdigest(), edited, after))
    return found


def test_documents(spark, documents):
    rows = sorted(((r.doc_id, r.text) for r in documents.collect()), reverse=True)
    got = {r.doc_id: r for r in registry.op13_improbable_digest(spark, SF).collect()}
    ranks = digest.rarity(documents)
    assert len(got) == len(rows)
    prints, better = {}, 0
    for name, n, sha, edited, after in edits_by_hand(rows):
        row = got[name]
        own, changed, following = digest.digests([dict(rows)[name].encode(), edited.encode(), after.encode()], ranks)
        assert (row.n_chars, row.edited_sha256) == (n, sha)
        assert row.near_edited == pytest.approx(digest.likeness(own, changed), abs=1e-6)
        assert row.near_next == pytest.approx(digest.likeness(own, following), abs=1e-6)
        assert prints.setdefault(dict(rows)[name], row.fingerprint) == row.fingerprint
        better += row.near_edited > row.near_next or n < 300
    assert better >= 0.99 * len(rows)


def test_odd_rows(spark, odd, none):
    ranks = np.arange(digest.LEVELS + 1)
    made = digest.edit_audit(odd.withColumn("place", F.lit(1)).withColumn("first", F.lit("x")), ranks)
    assert made.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = made.collect()
    texts = {}
    for r in odd.collect():
        texts.setdefault(r.doc_id, set()).add(len(r.text or ""))
    assert len(got) == odd.count() and all(r.n_chars in texts[r.doc_id] for r in got)
    assert all(0 <= v <= 1 for r in got for v in (r.near_edited, r.near_next))
    assert {tuple(r) for r in digest.edit_audit(odd.repartition(5), ranks).collect()} == {tuple(r) for r in got}
    assert digest.edit_audit(none, ranks).count() == 0
    assert sorted(digest.rarity(none).tolist()) == list(range(digest.LEVELS + 1))
    assert digest.fingerprints(odd, ranks).where("doc_id = 3 and length(fingerprint) = 4").count() == 1
    alone = digest.edit_audit(odd.where("doc_id = 6"), ranks).first()
    assert alone.near_next == 1.0 and 0.4 < alone.near_edited <= 1.0


def test_order_does_not_depend_on_ranges(spark, documents):
    ranks = np.arange(digest.LEVELS + 1)
    few = documents.limit(60).select("doc_id", F.left("text", F.lit(300)).alias("text"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = []
        for parts in ("1", "7", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append(sorted(tuple(r) for r in digest.edit_audit(few, ranks).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert found[0] == found[1] == found[2]
    rows = sorted(((r.doc_id, r.text) for r in few.collect()), reverse=True)
    assert [r[:3] for r in reversed(found[0])] == [r[:3] for r in edits_by_hand(rows)]
