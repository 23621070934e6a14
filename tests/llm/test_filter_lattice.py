"""Every order walked by hand on single documents; path counts; odd rows."""

import math
import re
from itertools import permutations

from hypothesis import given, settings
from hypothesis import strategies as st

from tramlag.llm import filter_lattice

WORDS = r"[^\x20\x09-\x0D]+"


def by_hand(rows, labels):
    """rows: (id, text, part); labels: (id, quality, toxic)."""
    docs = []
    for name, text, part in rows:
        text = text or ""
        words = re.findall(WORDS, text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": any(c in text for c in "#$%&*|"),
            "E": name is not None and any(n is not None and n < name and (t or "") == text for n, t, _ in rows),
        }
        good = name is not None and any(n == name and q == 1 for n, q, _ in labels)
        toxic = name is not None and any(n == name and x == 1 for n, _, x in labels)
        docs.append((part or "", {k for k, v in fails.items() if v}, good, toxic))
    found, removed_by = {}, {}
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left, gone = [d for d in docs if d[0] == part], []
            for step, letter in enumerate(order, 1):
                hit = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                redundant = sum(letter in d[1] for d in gone)
                gone += hit
                unique = sum(d[0] == part and d[1] == {letter} for d in docs)
                own = (len(left), len(hit), redundant, unique, sum(d[2] for d in hit), sum(d[3] for d in hit))
                found[part, "".join(order), step] = own
                removed_by[part, letter] = removed_by.get((part, letter), 0) + len(hit)
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def check(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = filter_lattice.interactions(docs, marks).collect()
    want = by_hand(rows, labels)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == want and len(got) == len(want)
    assert all(type(v) is int for r in got for v in tuple(r)[3:])


def test_all_orders(spark):
    long = " ".join(f"w{i}" for i in range(200))
    texts = [long, long + " $", long.upper(), "short", "a a a a", "", None, "A% b", long.replace("w", "ü"), " ".join("ab" * 120)]
    rows = [(i, t, p) for p in ("en", None, "", "de") for i, t in enumerate(texts * 2)]
    rows += [(None, long, "en"), (None, long, "en"), (3, "short", "en"), (3, "short", "en"), (90, "short", "fr"), (2, "short", "fr")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 20, 2)] + [(1, 1, 1), (1, 0, 0), (None, 1, 1), (5, None, None)]
    check(spark, rows, [(i, q, None if x is None else int(x)) for i, q, x in labels])


def test_part_of_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in documents.collect()]
    check(spark, rows + rows[:20] + [(-1, rows[3][1], "xx")], [tuple(r) for r in labels.collect()])


def test_odd_rows_and_clashing_names(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    clashing = odd.selectExpr("*", "source as lang", "1 as fails", "2 as part", "3 as digest", "4 as n", "5 as first")
    assert filter_lattice.interactions(clashing, labels).count() == 3 * 600
    assert filter_lattice.interactions(none.selectExpr("*", "source as lang"), labels).count() == 0
    assert filter_lattice.interactions(clashing, labels.limit(0)).where("good_lost > 0").count() == 0


def test_a_third_of_all_rows_in_one_group(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) as text", "'en' as lang"
    )
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    last = filter_lattice.interactions(docs, labels).where("filter_order = 'EABCD' and step = 1").first()
    assert (last.removed, last.good_lost, last.kept) == (999, 999, 2001)


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 7))
def test_path_counts(n):
    forward, backward = filter_lattice.paths(n)
    for state in range(1 << n):
        size = state.bit_count()
        assert forward[state] == math.factorial(size) and backward[state] == math.factorial(n - size)
