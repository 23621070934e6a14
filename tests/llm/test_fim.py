"""Cuts against plain slicing of code points, exact round trips, odd rows."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tramlag.llm import fim_sparse

TEXT = "a €b𝄞c é́ 日本語 end <"


def by_hand(key, text, seed=1, marks=("<P>", "<S>", "<M>")):
    text, n = text or "", len(text or "")
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in marks) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, s, m = marks
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, s + text[b:] + p + text[:a] + m + text[a:b]
    return n, "psm", a, b - a, p + text[:a] + s + text[b:] + m + text[a:b]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é€𝄞日́\n"))
def test_index_converts_every_position(text):
    data = text.encode()
    index = fim_sparse.Exceptions(np.frombuffer(data, np.uint8))
    points = np.arange(len(text) + 1)
    at = np.array([len(text[:i].encode()) for i in points])
    assert index.to_bytes(points).tolist() == at.tolist()
    assert index.to_points(at).tolist() == points.tolist()


def check(df, **options):
    want, got = [], []
    for row in fim_sparse.transform(df, **options).collect():
        want.append(by_hand(row.doc_id, row.text))
        got.append(tuple(row[-1]))
    assert got == want
    name = fim_sparse.transform(df, **options).columns[-1]
    made = fim_sparse.transform(df, **options).select(
        "text", fim_sparse.restored(F.col(f"{name}.output"), F.col(f"{name}.form")).alias("back")
    )
    assert all((r.text or "") == r.back for r in made.collect())
    return got


def test_documents(documents):
    forms = {r[1] for r in check(documents)}
    assert forms == {"plain", "psm", "spm"}


def test_odd_rows(spark, odd, none):
    check(odd)
    assert fim_sparse.transform(none).count() == 0
    rows = [(i, t) for i in range(60) for t in (TEXT, "<", "x<P", ">y", "in <M> it", "𝄞", "<P>", "tail <S>")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r[1] for r in check(df)} == {"plain", "psm", "spm"}
    assert {r[1] for r in check(df.where("text like '%<M>%'"))} == {"plain"}


def test_clashing_names(odd):
    df = odd.withColumn("fim", F.lit(1)).withColumn("draw", F.lit("x")).withColumn("FIM_", F.lit(None).cast("string"))
    made = fim_sparse.transform(df)
    assert made.columns == [*df.columns, "fim__"]
    check(df)
