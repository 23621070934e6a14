"""Held-out accuracy of the learned operators, and their defined results for odd rows."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from tramlag.llm import licence_lr, quality_ordinal, registry, toxicity_ac
from tramlag.llm.common import first_by_hash

SF = "/root/testdata/sf0.01"


def test_ordinal_model_learns_ordered_grades(spark):
    rng = np.random.default_rng(2)
    noise = ["%%%", "***", "&&&"]
    rows, grades = [], []
    for i in range(600):
        grade = i % 4
        words = [f"w{rng.integers(300)}" + (rng.choice(noise) if rng.random() < 0.25 * (3 - grade) else "") for _ in range(60)]
        rows.append((i, " ".join(words)))
        grades.append((i, grade))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = quality_ordinal.train(docs.where("doc_id < 450"), spark.createDataFrame(grades, "doc_id bigint, quality int"))
    assert (np.diff(model.cuts) > 0).all() and model.grades == [0.0, 1.0, 2.0, 3.0]
    got = quality_ordinal.grade(docs.where("doc_id >= 450"), model, wanted=2).collect()
    off = [abs(r._expected - r.doc_id % 4) for r in got]
    assert np.mean(off) < 0.4
    assert np.mean([(r._tail >= 0.5) == (r.doc_id % 4 >= 2) for r in got]) > 0.9


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_ordinal.train(docs, labels.where(f"not ({registry.HELD_OUT})"))
    got = quality_ordinal.grade(docs, model).join(labels.where(registry.HELD_OUT), "doc_id").collect()
    assert np.mean([(r._tail >= 0.5) == (r.quality == 1) for r in got]) > 0.95


def test_quality_of_odd_rows(spark, odd, none):
    ratings = spark.createDataFrame([(1, 1), (1, 0), (6, 1), (None, 1), (2, None), (99, 0), (4, 0)], "doc_id bigint, quality int")
    model = quality_ordinal.train(odd, ratings)
    got = quality_ordinal.grade(odd, model)
    assert got.columns == [*odd.columns, "_expected", "_tail"] and got.count() == odd.count()
    assert all(0 <= r._tail <= 1 and 0 <= r._expected <= 1 for r in got.collect())
    assert quality_ordinal.grade(none, model).count() == 0
    clash = odd.selectExpr("*", "1 as _expected", "2 as _tail", "3 as _text", "4 as _grade", "5 as quality")
    again = quality_ordinal.grade(clash, quality_ordinal.train(clash, ratings))
    assert again.columns == [*clash.columns, "_expected_", "_tail_"]
    assert sorted(r._tail_ for r in again.collect()) == sorted(r._tail for r in got.collect())
    plain = quality_ordinal.train(odd, ratings.limit(0))
    assert {(r._expected, r._tail) for r in quality_ordinal.grade(odd, plain).collect()} == {(0.0, 1.0)}


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = registry.op9_toxicity_lexicon(spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert np.mean([r.predicted for r in toxic]) > 0.85
    assert np.mean([r.predicted for r in clean]) < 0.02


def test_disguised_words_match_and_harmless_phrases_do_not():
    table = toxicity_ac.Folding()
    words = ["idiot", "1d10t", "ídïót", "ІDІОТ", "i​diot", "ｉｄｉｏｔ", "𝐢𝐝𝐢𝐨𝐭"]
    assert {toxicity_ac.folded(w, table) for w in words} == {" idiot "}
    lexicon = toxicity_ac.Lexicon({" idiot ": 5.0, " ciown": 3.0}, {"ciown fish"})
    automaton = lexicon.automaton()
    weight = lambda t: toxicity_ac.weight_of(toxicity_ac.folded(t, table), automaton, lexicon.exceptions)
    assert weight("you 1diot, you cl0wns!") == 8.0
    assert weight("a clown fish and a clown") == 3.0
    assert weight("idiotic") == 0.0 and weight("") == 0.0


def test_numbers_and_other_scripts_are_left_alone():
    table = toxicity_ac.Folding()
    fold = lambda t: toxicity_ac.folded(t, table)
    assert fold("call 455 or 1337 !!! 0.5%") == " caii or "
    assert fold("455hole a55") == " asshoie ass "
    assert fold("привет κόσμε") == fold("ПРИВЕТ  κοσμε") and len(fold("привет").split()) == 1
    assert fold("日本語 text") == " 日本語 text "
    assert fold(None) == fold("") == fold(" 12 ") == "  "


def test_scores_against_plain_loops(spark, documents):
    """Every score from a scan of each word, without an automaton."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    lexicon = toxicity_ac.train(documents, labels)
    lexicon.weights |= {" the ": 0.5, " onth": 1.5, " on": 0.25}
    lexicon.exceptions |= {"of the", "the was"}
    table = toxicity_ac.Folding()
    got = {r.doc_id: r._score for r in toxicity_ac.score(documents, lexicon).collect()}
    for row in documents.limit(60).collect():
        words = toxicity_ac.folded(row.text, table).split()
        total = 0.0
        for i, word in enumerate(words):
            hits = [w for e, w in lexicon.weights.items() if f" {word} ".startswith(e)]
            phrases = {" ".join(words[max(0, i - 1) : i + 1]), " ".join(words[i : i + 2])}
            total += max(hits, default=0.0) * (not phrases & lexicon.exceptions)
        want = lexicon.score(np.array([total]), np.array([float(len(words))]))[0]
        assert abs(got[row.doc_id] - want) < 1e-9


def test_held_out_is_never_null(spark, odd, monkeypatch):
    labels = spark.createDataFrame([(1, 1), (6, 0)], "doc_id bigint, toxic int")
    monkeypatch.setattr(registry, "_table", lambda spark, sf, name: odd if name == "documents" else labels)
    rows = registry.op9_toxicity_lexicon(spark, "").collect()
    assert len(rows) == odd.count() and {r.held_out for r in rows} <= {True, False}
    clash = odd.selectExpr("*", "1 as _score", "2 as _text", "3 as _toxic")
    assert toxicity_ac.score(clash, toxicity_ac.train(clash, labels)).columns[-1] == "_score_"


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (2, None)], "doc_id bigint, toxic int")
    lexicon = toxicity_ac.train(odd, labels)
    got = toxicity_ac.score(odd, lexicon)
    assert got.columns == [*odd.columns, "_score"] and got.count() == odd.count()
    assert all(0 <= r._score <= 1 for r in got.collect())
    assert toxicity_ac.score(none, lexicon).count() == 0
    assert toxicity_ac.train(odd, labels.limit(0)).weights == {}


def test_licence_lines_are_found_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = {"GNU General": "gpl", "CC BY-NC": "cc-by-nc", "MIT License": "mit", "Apache License": "apache"}
    want = {
        (r.doc_id, i, family)
        for r in docs.collect()
        for i, line in enumerate(r.text.split("\n"))
        for words, family in lines.items()
        if words in line
    }
    got = registry.op6_licence_classifier(spark, SF).collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in got} == want and len(got) == len(want)


def test_lines_that_no_notice_holds(spark):
    """Paraphrases and lines of wrapped headers: 11 of 13 are found, and nothing is among ordinary sentences."""
    model = licence_lr.train(spark.read.parquet(f"{SF}/documents.parquet"))
    held = {w for wordings in licence_lr.NOTICES.values() for w in wordings}
    unseen = [
        ("mit", "This software is released under the MIT License."),
        ("mit", "The code in this repository is licensed under the terms of the MIT license."),
        ("apache", "This project is licensed under the Apache License, Version 2.0."),
        ("apache", "# Licensed under the Apache License, Version 2.0 (the \"License\");"),
        ("apache", " * you may not use this file except in compliance with the License."),
        ("bsd", "This software is released under the BSD 3-Clause License."),
        ("gpl", "This program is licensed under the GNU General Public License, version 3 or later."),
        ("gpl", " * it under the terms of the GNU General Public License as published by"),
        ("lgpl", "This module is licensed under the GNU Lesser General Public License, version 3."),
        ("agpl", "This server is licensed under the GNU Affero General Public License, version 3."),
        ("mpl", "The library is licensed under the Mozilla Public License, version 2.0."),
        ("cc-by", "The text is licensed under a Creative Commons Attribution 4.0 International License."),
        ("public-domain", "This data set was released into the public domain."),
        (None, "The driver's licence was renewed under the new rules of the city."),
        (None, "The general public may use this file of photographs without restriction."),
        (None, "A version of the story was published by the foundation."),
        (None, "The library is free and open to any person, in every public square."),
    ]
    assert not held & {x for _, x in unseen}
    more = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(unseen)], "doc_id bigint, text string")
    named = {r.doc_id: r.family for r in licence_lr.scan(more, model).collect()}
    assert all(named.get(i) == f for i, (f, _) in enumerate(unseen) if not f or i in named)
    assert len(named) >= 11


def test_wordings_of_the_table_held_out_of_the_notices(spark):
    """Without the table's four wordings those of two families are still found, as just these lines; the
    short ones of the other two have no notice like them left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    family = {"GNU General": "gpl", "MIT License": "mit", "CC BY-NC": "cc-by-nc", "Apache License": "apache"}
    lines = [(r.doc_id, i, x.strip(), f) for r in docs.collect() for i, x in enumerate(r.text.split("\n")) for w, f in family.items() if w in x]
    rest = {f: [w for w in wordings if w not in {x for _, _, x, _ in lines}] for f, wordings in licence_lr.NOTICES.items()}
    assert sum(map(len, licence_lr.NOTICES.values())) - sum(map(len, rest.values())) == 4
    found = licence_lr.scan(docs, licence_lr.train(docs, families=rest), families=rest).collect()
    got, places = {(r.doc_id, r.paragraph, r.family) for r in found}, {(d, i) for d, i, _, _ in lines}
    assert {(d, i, f) for d, i, _, f in lines if f in ("gpl", "mit")} <= got
    assert {(d, i) for d, i, _ in got} <= places  # never anything but a licence line


def test_licence_scan_of_odd_rows(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = licence_lr.train(docs, sample_rows=200)
    more = spark.createDataFrame(
        [
            (8, "\n\nReleased under the mit license\n", "a", 1),
            (8, "THE SOFTWARE IS LICENSED UNDER THE APACHE LICENSE, VERSION 2.0", "a", 1),
            (None, "SPDX-License-Identifier: GPL-3.0-or-later", "a", 1),
            (9, "The licence of the driver was lost under the bridge.", "a", 1),
        ],
        odd.schema,
    )
    got = {(r.doc_id, r.paragraph, r.family) for r in licence_lr.scan(odd.unionByName(more), model).collect()}
    assert got == {(8, 2, "mit"), (8, 0, "apache"), (None, 0, "gpl")}
    assert licence_lr.scan(none, model).count() == 0


def test_licence_fit_and_threshold_cover_every_row(spark):
    """Lines near a notice that stand only in rows behind the first 600 by a hash of the id: none may pass for known."""
    early = {r.id for r in first_by_hash(spark.range(1400), "id", 600, 1400).collect()}
    near = "We met under the MIT license plate {} of a museum."
    rows = [(i, ("The river was low this summer near gate {}." if i in early else near).format(i)) for i in range(1400)]
    rows.append((1400, "Released under the MIT License."))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = licence_lr.train(docs)
    weights = dict(model.weights)

    def known(text):
        words = ["^", *re.findall(r"[\w-]+", text.lower()), "$"]
        held = [weights[p] for p in {f"{a} {b}" for a, b in zip(words, words[1:])} if p in weights]
        powers = [math.exp(b + sum(w[c] for w in held)) for c, b in enumerate(model.intercepts)]
        return max(powers[1:]) / sum(powers)

    assert not any(known(text) >= model.threshold for i, text in rows[:1400] if i not in early)
    assert [(r.doc_id, r.family) for r in licence_lr.scan(docs, model).collect()] == [(1400, "mit")]


def test_licence_threshold_is_the_least_that_keeps_the_share(spark):
    rng = np.random.default_rng(4)
    for most in (1.0, 0.9, 0.2):
        scores = np.concatenate([rng.random(400) * most, np.repeat(rng.random(5) * most, 7), np.full(3, most)])
        times = rng.integers(1, 4, len(scores))
        rows = spark.createDataFrame([(float(x), int(n)) for x, n in zip(scores, times)], "_known double, _n bigint")
        for share in (0.0, 0.001, 0.05, 0.3):
            got = licence_lr._threshold(rows, share, 0.5)
            assert times[scores >= got].sum() <= share * times.sum()
            under = scores[(scores < got) & (scores >= 0.5)]
            assert got == 0.5 or times[scores >= under.max()].sum() > share * times.sum()
    assert licence_lr._threshold(rows.limit(0), 0.001, 0.5) == 0.5


def test_licence_classify_is_train_and_scan(spark, odd, none):
    more = [(8, "\n\nReleased under the mit license\n", "a", 1), (None, "SPDX-License-Identifier: GPL-3.0-or-later", "a", 1)]
    docs = odd.unionByName(spark.createDataFrame(more, odd.schema))
    columns = ["doc_id", "paragraph", "family", F.round("probability", 6), "share"]
    found = licence_lr.classify(docs)
    want = licence_lr.scan(docs, licence_lr.train(docs))
    assert found.columns == want.columns
    rows = lambda df: sorted(map(tuple, df.select(*columns).collect()), key=str)
    assert rows(found) == rows(want) and {r[2] for r in rows(found)} == {"mit", "gpl"}
    assert licence_lr.classify(none).count() == 0
