"""Packing round trips to the tokens; mixing meets independently computed shares."""

import zlib

import numpy as np
import public_tokenizers as public
from conftest_llm import fair_queue
from tokenizers import Tokenizer

from tramlag.llm import mixing_wfq, packing_online, registry

WORDS = r"[^\x20\x09-\x0D]+"


def tokens(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check_packing(df, rows, room):
    tokenizer = Tokenizer.from_file(public.path(registry.TOKENIZER))
    pieces = df.collect()
    own = {}
    for p in pieces:
        own.setdefault(p.doc_id, []).append(p)
        assert len(p.ids) == 4 * p.length
    want = {}
    for name, text in rows:
        want.setdefault(name, []).append(tokens(tokenizer, text))
    assert set(own) == set(want)
    for name, lists in want.items():
        assert sum(p.length for p in own[name]) == sum(map(len, lists))
        if len(lists) == 1:
            ordered = sorted(own[name], key=lambda p: p.start)
            assert [p.start for p in ordered] == list(np.cumsum([0, *(p.length for p in ordered[:-1])]))
            assert np.concatenate([np.frombuffer(p.ids, "<u4") for p in ordered]).tolist() == lists[0]
            assert {p.doc_tokens for p in ordered} == {len(lists[0])}
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0, *(p.length for p in own[:-1])]))
        assert sum(p.length for p in own) <= room
    assert sum(sum(p.length for p in own) < room for own in sequences.values()) <= 1


def test_packing_round_trip(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    check_packing(registry.packed(documents.repartition(37)), rows, 1024)


def test_registered_query_gives_the_checksums_of_the_ids(spark, documents):
    """Checksums of the pieces against the tokenizer's own ids, cut by start and length."""
    tokenizer = Tokenizer.from_file(public.path(registry.TOKENIZER))
    want = {r.doc_id: np.array(tokens(tokenizer, r.text), "<u4") for r in documents.collect()}
    pieces = registry.op4_pack_online(spark, "/root/testdata/sf0.001").collect()
    assert sum(p.length for p in pieces) == sum(map(len, want.values()))
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(want[p.doc_id][p.start : p.start + p.length].tobytes())
        assert p.doc_tokens == len(want[p.doc_id])


def test_packing_odd_rows(odd, none):
    check_packing(registry.packed(odd), [(r.doc_id, r.text) for r in odd.collect()], 1024)
    assert registry.packed(none).count() == 0


def test_pieces_give_the_tokenizers_ids():
    encode = packing_online.encoder(public.path(registry.TOKENIZER), public.path(registry.RANKS), public.PATTERN)
    plain = packing_online.encoder(public.path(registry.TOKENIZER))
    tokenizer = Tokenizer.from_file(public.path(registry.TOKENIZER))
    texts = [
        "", " ", "  two  blanks ", "line\n \n next", "tab\t here", "it's  we'll", "a\x00b \x00 c", "<|endoftext|> in text",
        "ünïcödé　space \xa0 nbsp", "12 345,6 %%% !!", "   ", "end ", "\n\n a", "x\x1c y \x85 z", "emoji 🙂 🙂", "​ zero",
    ]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encode(texts)] == want
    assert [x.tolist() for x in plain(texts)] == want


def shares(size, most, weights=(1, 2, 3)):
    weight = {s: weights[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, (s or "").encode())))}
    target, left, free = {}, float(sum(size.values())), {s for s in size if size[s]}
    target.update({s: 0.0 for s in size if not size[s]})
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * size[s]]
        if not over:
            target.update({s: left * weight[s] / total for s in free})
            break
        for s in over:
            target[s] = float(most * size[s])
        left -= sum(target[s] for s in over)
        free -= set(over)
    return target


def check_mixing(docs):
    rows = mixing_wfq.queues(docs).collect()
    assert len(rows) == docs.count()
    size, taken = {}, {}
    for r in rows:
        assert r._size == len((r.text or "").encode().split())
        assert 0 <= r._taken <= 3 * r._size
        size[r.source] = size.get(r.source, 0) + r._size
        taken[r.source] = taken.get(r.source, 0) + r._taken
    target = shares(size, 3)
    for r in rows:
        assert abs(r._target - target[r.source]) < 1e-6 and r._source_size == size[r.source]
    assert all(abs(taken[s] - target[s]) < 1 for s in target)
    copies = mixing_wfq.mixture(docs)
    assert copies.columns == docs.columns
    assert sum(len(r.text.encode().split()) for r in copies.collect()) == sum(taken.values())


def test_mixing(documents):
    check_mixing(documents)


def test_mixing_with_a_hot_source_and_small_ones(spark):
    rows = [(i, "w " * (i % 9 + 1), "z" if i % 3 else f"s{i % 21}") for i in range(900)] + [(i, "x", "é") for i in range(900, 905)]
    check_mixing(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))


def test_mixing_odd_rows(odd, none):
    check_mixing(odd)
    assert mixing_wfq.queues(none).count() == 0 and mixing_wfq.mixture(none).count() == 0


def test_mixing_does_not_depend_on_the_order_of_reading(documents):
    once = {(r.doc_id, r._taken) for r in mixing_wfq.queues(documents).collect()}
    assert once == {(r.doc_id, r._taken) for r in mixing_wfq.queues(documents.repartition(9)).collect()}


def test_the_mixture_is_a_fair_queue_cut_at_the_budget(spark):
    """A plain simulation: all copies by virtual finish time, until the budget is spent."""
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(i % 7 + 1)), "abcd"[min(i % 11, 3)]) for i in range(400)]
    weight = dict(zip("abcd", (1, 2, 3, 1)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    want = fair_queue(rows, weight)
    got = [(r.doc_id, r.text) for r in mixing_wfq.mixture(docs).collect()]
    assert got == want


def test_mixing_with_clashing_names(odd):
    clash = odd.selectExpr("*", "1 as _size", "2 as _before", "3 as taken", "4 as key", "'x' as finish", "5 as words", "6 as bucket")
    assert mixing_wfq.queues(clash).columns == [*clash.columns, "_size_", "_source_size", "_target", "_before_", "_taken"]
    plain = sorted(map(repr, (r[:4] for r in mixing_wfq.mixture(odd).collect())))
    assert sorted(map(repr, (r[:4] for r in mixing_wfq.mixture(clash).collect()))) == plain
