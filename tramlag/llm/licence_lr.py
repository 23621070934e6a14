"""Licence families by a trained paragraph classifier, in DataFrame functions on the whole path.

A sparse multinomial logistic regression over word pairs, fitted on licence notices (below) and
the table's other paragraphs, gives every paragraph a probability for each family and for
`unknown`. The threshold that parts known from unknown is set on the paragraphs held out of the
fit. What is predicted is confirmed by comparing its word pairs with the notices. Only pairs that
notices hold have weights, so paragraphs with the same ones are fitted as one row that weighs as
much as all of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramlag.llm.common import first_by_hash, written

#: Weight in the fit of each other paragraph (a notice: 1), and of all of them together at most, in notices.
OTHER, OTHERS = 0.3, 14.0
#: Share of the held-out other paragraphs with a notice's pair that may come out as known, and how
#: much of the smaller of paragraph and notice the pairs in common must make up.
FALSE_KNOWN, CONFIRMED = 0.001, 0.6
#: Rows of the fit that a task takes.
FIT_ROWS = 1 << 16

# Wordings of public licences and of usual notices, by family.
NOTICES: dict[str, list[str]] = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the License.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD license.",
        "Licensed under the 2-Clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "Released under the GPL version 3 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
        "for more details.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation.",
    ],
    "mpl": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "public-domain": [
        "Released into the public domain.",
        "Dedicated to the public domain under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ],
}

UNKNOWN = "unknown"


#: What parts words, and a word with the one after it (overlapping, so the match itself is empty).
BETWEEN, PAIR = r"[^\p{L}\p{N}-]+", r"(?<![^ ])(?=([^ ]+ [^ ]+))"


def with_pairs(rows: DataFrame) -> DataFrame:
    """`rows` with pairs: neighbouring words of _paragraph in lower case, ends included. Without words no row."""
    plain = rows.withColumn("_plain", F.trim(F.regexp_replace(F.lower("_paragraph"), BETWEEN, " "))).where("_plain <> ''")
    ends = F.concat(F.lit("^ "), F.col("_plain"), F.lit(" $"))
    return plain.withColumn("pairs", F.regexp_extract_all(ends, F.lit(PAIR), F.lit(1))).drop("_plain")


def paragraphs(docs: DataFrame, text: str) -> DataFrame:
    """All columns of `docs`, with _row, _at (paragraph in the text) and _paragraph, one row a line that is not blank."""
    lines = docs.withColumn("_row", F.monotonically_increasing_id())
    return lines.select("*", F.posexplode(F.split(F.col(text), "\r?\n")).alias("_at", "_paragraph")).where("trim(_paragraph) <> ''")


@dataclass
class Classifier:
    """(pair, weights by class) of the notices' pairs, intercepts, classes, and the threshold for known."""

    weights: list[tuple[str, list[float]]]
    intercepts: list[float]
    classes: list[str]
    threshold: float


def notices(spark: SparkSession, families: dict[str, list[str]]) -> DataFrame:
    """(family, notice, _paragraph); a wording of several sentences also gives each by itself."""
    rows = []
    for family, wordings in families.items():
        for wording in wordings:
            sentences = wording.split(". ")
            rows += [(family, f"{family}-{len(rows)}-{k}", s) for k, s in enumerate([wording, *(sentences if len(sentences) > 1 else [])])]
    return spark.createDataFrame(rows, "family string, notice string, _paragraph string")


def _known(spark: SparkSession, families: dict[str, list[str]] | None) -> DataFrame:
    """The notices with their distinct pairs."""
    return with_pairs(notices(spark, families or NOTICES)).withColumn("pairs", F.array_distinct("pairs"))


def _vocabulary(known: DataFrame) -> list[str]:
    return sorted(r[0] for r in known.select(F.explode("pairs")).distinct().collect())


def marked(docs: DataFrame, vocabulary: list[str], id_column: str, text: str) -> DataFrame:
    """(id column, _row, _at, _second, _own, pairs), a row a paragraph with words: whether it serves the threshold
    instead of the fit, its number of pairs, and those in `vocabulary`, each once and sorted."""
    lines = paragraphs(docs.select(id_column, text), text).select(id_column, "_row", "_at", "_paragraph")
    second = F.pmod(F.xxhash64("_paragraph"), F.lit(2)) == 1
    held = F.array_intersect("pairs", F.array(*[F.lit(p) for p in vocabulary]).cast("array<string>"))
    own = F.size("pairs").alias("_own")
    return with_pairs(lines).select(id_column, "_row", "_at", second.alias("_second"), own, F.sort_array(held).alias("pairs"))


def train(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", families: dict[str, list[str]] | None = None,
    sample_rows: int | None = None,
) -> Classifier:
    """Fit on the notices and on all paragraphs of `docs`, or of `sample_rows` rows of it if a caller names a number.

    The threshold comes from every second paragraph, which the fit leaves out.
    """
    if sample_rows is not None:
        docs = first_by_hash(docs.select(id_column, text), id_column, sample_rows, docs.count())
    marks = marked(docs, _vocabulary(_known(docs.sparkSession, families)), id_column, text)
    return _fitted(written(marks, "licence-paragraphs"), families)


def _fitted(marks: DataFrame, families: dict[str, list[str]] | None) -> Classifier:
    """Fit on the notices and on the written rows of `marked`.

    Paragraphs that read like a notice (as in confirmation) are left out; of the others every
    second serves the fit, the rest the threshold. The driver gets the weights of pairs that
    occur in notices, never a paragraph of the table.
    """
    known = _known(marks.sparkSession, families).cache()
    vocabulary = _vocabulary(known)
    classes = [UNKNOWN, *sorted({r[0] for r in known.select("family").distinct().collect()})]
    alike = marks.groupBy("_second", "_own", "pairs").agg(F.count("*").alias("_n"))
    alike = written(alike.withColumn("_set", F.monotonically_increasing_id()), "licence-sets")
    other = alike.join(_confirmed(alike, ["_set"], known), "_set", "left_anti")
    first = other.where("not _second").groupBy("pairs").agg(F.sum("_n").alias("_n"))
    number = other.where("not _second").agg(F.sum("_n")).first()[0] or 1
    each = min(OTHER, OTHERS * known.count() / number)
    label = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")) - 1
    rows = known.select("family", "pairs", F.lit(1.0).alias("weight")).unionByName(
        first.select(F.lit(UNKNOWN).alias("family"), "pairs", (F.col("_n") * each).alias("weight"))
    )
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="pairs", outputCol="features", minTF=1.0)
    counter = counter.setBinary(True)
    data = written(counter.transform(rows.select(label.cast("double").alias("label"), "weight", "pairs")).drop("pairs"), "licence-fit")
    model = LogisticRegression(
        family="multinomial", weightCol="weight", regParam=0.0002, elasticNetParam=0.5, maxIter=120, standardization=False
    ).fit(data.coalesce(1 + data.count() // FIT_ROWS))
    matrix = model.coefficientMatrix.toArray()
    present = list(range(matrix.shape[0]))
    weights = [(pair, [float(matrix[c, i]) for c in present]) for i, pair in enumerate(vocabulary)]
    found = Classifier(weights, [float(x) for x in model.interceptVector], [classes[c] for c in present], 0.5)
    scored = written(_scored(other.where("_second"), ["_set", "_n"], found).select("_known", "_n"), "licence-scores")
    found.threshold = _threshold(scored, FALSE_KNOWN, 0.5)
    known.unpersist()
    return found


def _threshold(scored: DataFrame, share: float, least: float) -> float:
    """From `least` on, the first place between scores that at most `share` of the rows (_known, _n of each) reach.

    Counts by intervals of the scores, an interval at a time into smaller ones: the driver gets a
    thousand counts a turn.
    """
    most = share * (scored.agg(F.sum("_n")).first()[0] or 0)
    low, high, above, higher = least, 1.0, 0, 1.0
    while True:
        part = F.floor((F.col("_known") - low) / (high - low) * 1000)
        within = scored.where(F.col("_known").between(low, high)).groupBy(part.alias("part"))
        for r in sorted(within.agg(F.sum("_n").alias("n"), F.min("_known").alias("low"), F.max("_known").alias("high")).collect(), reverse=True):
            if above + r.n > most:
                break
            above, higher = above + r.n, r.low
        else:
            return least
        if r.low == r.high:
            return (r.low + higher) / 2 if higher > r.low else math.nextafter(r.low, 2)
        low, high = r.low, r.high


def _scored(rows: DataFrame, keys: list[str], model: Classifier) -> DataFrame:
    """`keys` (which may be null), _own, _family, _known (probability of it) and pairs of those rows of `marked`
    that share a pair with a notice."""
    spark = rows.sparkSession
    # bounded by the notices' wording, whatever the table
    weights = F.broadcast(spark.createDataFrame(model.weights or [("", [0.0] * len(model.classes))], "pair string, w array<double>"))
    # the pairs move, not the sums of all classes
    exploded = rows.select(*keys, "_own", F.explode("pairs").alias("pair")).repartition(*keys).join(weights, "pair")
    sums = [F.sum(F.element_at("w", i + 1)).alias(f"_w{i}") for i in range(len(model.classes))]
    keys = [*keys, "_own"]
    summed = exploded.groupBy(*keys).agg(*sums, F.collect_list("pair").alias("pairs"))
    logits = F.array(*[F.col(f"_w{i}") + F.lit(b) for i, b in enumerate(model.intercepts)])
    powers = summed.select(*keys, "pairs", logits.alias("_logits"))
    powers = powers.select(*keys, "pairs", F.transform("_logits", lambda x: F.exp(x - F.array_max("_logits"))).alias("_powers"))
    total = F.aggregate("_powers", F.lit(0.0), lambda a, b: a + b)
    known = F.slice("_powers", 2, len(model.classes) - 1)  # unknown is the first class
    place = F.array_position(known, F.array_max(known))
    names = F.array(*[F.lit(c) for c in model.classes[1:]])
    return powers.select(*keys, "pairs", F.element_at(names, place.cast("int")).alias("_family"), (F.array_max(known) / total).alias("_known"))


def _confirmed(rows: DataFrame, keys: list[str], known: DataFrame, family: str | None = None) -> DataFrame:
    """Rows whose pairs make up CONFIRMED of the smaller of them and a notice (of column `family`, if
    given), with _share. `known` is bounded by the notices' wording."""
    of = known.select("notice", F.col("family").alias("_of"), F.size("pairs").alias("_size"), F.explode("pairs").alias("pair"))
    columns = [*keys, *([family] if family else [])]
    own = rows.select(*columns, "_own", F.explode("pairs").alias("pair"))
    same = own.join(F.broadcast(of), "pair")
    if family:
        same = same.where(F.col(family) == F.col("_of"))
    shared = same.groupBy(*columns, "_own", "notice", "_size").count()
    share = F.col("count") / F.least("_own", "_size")
    best = shared.groupBy(*columns).agg(F.max(share).alias("_share"))
    return best.where(F.col("_share") >= CONFIRMED)


def scan(
    docs: DataFrame, model: Classifier, id_column: str = "doc_id", text: str = "text",
    families: dict[str, list[str]] | None = None,
) -> DataFrame:
    """(id column, paragraph, family, probability, share): a row for each licence paragraph found.

    `paragraph` counts the lines of the text from 0, blank ones included; `share` is how much of
    the smaller of paragraph and closest notice of the family the pairs in common make up. Null
    and empty texts and an empty table have no licence paragraphs. Rows that repeat an id, or
    have none, are scanned each for itself; other columns go unread.
    """
    return _found(marked(docs, [pair for pair, _ in model.weights], id_column, text), model, id_column, families)


def classify(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", families: dict[str, list[str]] | None = None
) -> DataFrame:
    """`scan` of `docs` by a model fitted on `docs` itself (`train`); the texts are cut into pairs once for both."""
    marks = marked(docs, _vocabulary(_known(docs.sparkSession, families)), id_column, text)
    marks = written(marks, "licence-paragraphs")
    return _found(marks, _fitted(marks, families), id_column, families)


def _found(marks: DataFrame, model: Classifier, id_column: str, families: dict[str, list[str]] | None) -> DataFrame:
    keys = [id_column, "_row", "_at"]
    found = _scored(marks, keys, model).where(F.col("_known") >= model.threshold)
    sure = _confirmed(found, [*keys, "_known"], _known(marks.sparkSession, families), "_family")
    return sure.select(
        id_column, F.col("_at").alias("paragraph"), F.col("_family").alias("family"),
        F.col("_known").alias("probability"), F.col("_share").alias("share"),
    )
