"""Toxicity by a learned, weighted lexicon matched with Aho-Corasick over folded text.

Folding maps look-alike letters, accents and digits written for letters to plain a-z, so that
disguised words read like open ones; numbers stay out of it. The lexicon (words and beginnings of words) and its
weights come from counts over labelled documents, as do phrases in which a word is harmless.
The matched weight, alone and in relation to the length, gives a calibrated score.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramlag.llm.common import extended, first_by_hash, free, slices, written

#: Labelled rows that are learned from, at most, of either class (first by a hash of the id).
FIT_TOXIC, FIT_CLEAN = 6_000, 12_000
#: Lengths of word beginnings that are tried, toxic documents that an entry of the lexicon needs.
BEGINNINGS = (4, 5, 6, 7)
LEAST_DOCS = 4
#: Log odds and log-likelihood ratio that an entry needs: neither weak nor a chance find.
LEAST_ODDS, LEAST_RATIO = 1.2, 24.0
TEXT_BYTES = 4 << 20

#: Letters of other scripts that look like a Latin one, and digits and signs written for letters.
LOOKALIKES = str.maketrans(
    "авгеёзікмнопрстухѕјіԁɡһӏѵԛԝ" "αβεικνορτυχω" "0134578@$ıł",
    "abreeeikmhonpctyxsjidghlvqw" "abeikvoptuxw" "oieastbasil",
)


class Folding(dict):
    """str.translate table that works out a character when it is first seen."""

    def __missing__(self, code: int) -> str:
        plain = unicodedata.normalize("NFKD", chr(code)).casefold().translate(LOOKALIKES)
        plain = unicodedata.normalize("NFKD", plain)
        letters = "".join(c for c in plain if c.isalpha())
        invisible = unicodedata.category(chr(code)) in ("Mn", "Cf")
        self[code] = letters or ("" if invisible else " ")
        return self[code]


#: Words without a letter: numbers and signs, which stand for themselves.
NO_LETTER = re.compile(r"(?<!\S)(?:(?!\s)[\W\d_])+(?!\S)")


def folded(text: str | None, table: Folding) -> str:
    """Folded words, one blank between and around them. 1, l and i read alike: all become i.

    Digits and signs count as letters only in words that hold a letter. Letters that look like no
    Latin one stay as they are.
    """
    return f" {' '.join(NO_LETTER.sub(' ', text or '').translate(table).replace('l', 'i').split())} "


def entries_of(text: str) -> set[str]:
    """What a folded text could be recognised by: its words and their beginnings."""
    words = set(text.split())
    return {f" {w} " for w in words if len(w) > 2} | {f" {w[:k]}" for w in words for k in BEGINNINGS if len(w) >= k}


@dataclass
class Lexicon:
    """Entries with weights, harmless phrases, and the calibration of the matched weight."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    scale: list[float] = field(default_factory=lambda: [-4.0, 0.0, 0.0])

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        if self.weights:
            found.make_automaton()
        return found if self.weights else None

    def score(self, weight: np.ndarray, length: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(measures(weight, length) @ np.array(self.scale), -40, 40)))


def measures(weight: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Constant, matched weight, and matched weight a hundred words."""
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / np.maximum(length, 1))], axis=1)


def matches(text: str, automaton: ahocorasick.Automaton | None) -> Iterator[tuple[float, str, str]]:
    """(weight, word with the one before, word with the one after), the heaviest entry of each word."""
    if automaton is None:
        return
    best: dict[int, float] = {}
    for end, (length, weight) in automaton.iter(text):
        begin = end - length + 1
        best[begin] = max(best.get(begin, 0.0), weight)
    for begin, weight in best.items():
        stop = text.index(" ", begin + 1)
        left = text[text.rfind(" ", 0, begin) + 1 : stop] if begin else text[1:stop]
        after = text.find(" ", stop + 1)
        yield weight, left, text[begin + 1 : after if after > 0 else stop]


def weight_of(text: str, automaton, exceptions: set[str]) -> float:
    return sum(w for w, left, right in matches(text, automaton) if left not in exceptions and right not in exceptions)


def _calibrate(weight, length, toxic, importance) -> list[float]:
    """Weighted logistic regression by Newton steps, with a small ridge."""
    x = measures(weight, length)
    theta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (importance * (toxic - p)) - 0.05 * theta
        curve = (x * (importance * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.05 * np.eye(len(theta))
        theta = theta + np.clip(np.linalg.solve(curve, gradient), -3, 3)
    return theta.tolist()


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
    fit_toxic: int = FIT_TOXIC, fit_clean: int = FIT_CLEAN, exceptions: tuple[str, ...] = (),
) -> Lexicon:
    """Lexicon from labelled rows: at most `fit_toxic` with label 1 and `fit_clean` with label 0.

    Null ids, labels and texts are left out; of several labels of an id the largest counts.
    Without a toxic or without a clean row the lexicon is empty. `exceptions` are harmless
    phrases of two words, besides those learned.
    """
    known = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(id_column).agg(F.max(F.col(label).cast("int")).alias("_toxic"))
    numbers = {r[0]: r[1] for r in known.groupBy("_toxic").count().collect()}
    if not numbers.get(1) or not numbers.get(0):
        return Lexicon()
    chosen = first_by_hash(known.where("_toxic = 1"), id_column, fit_toxic, numbers[1]).unionByName(
        first_by_hash(known.where("_toxic = 0"), id_column, fit_clean, numbers[0])
    )
    sample = docs.select(id_column, F.col(text).cast("string").alias("_text")).where("_text is not null")
    sample = written(sample.join(chosen, id_column).select("_text", "_toxic"), "labelled")
    of_class = {r[0]: r[1] for r in sample.groupBy("_toxic").count().collect()}
    toxic_docs, clean_docs = of_class.get(1, 0), of_class.get(0, 0)
    if not toxic_docs or not clean_docs:
        return Lexicon()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Folding()
        for part in slices(batches, "_text", TEXT_BYTES):
            seen = (Counter(), Counter())
            for t, toxic in zip(part.column("_text").to_pylist(), part.column("_toxic").to_pylist()):
                seen[toxic].update(entries_of(folded(t, table)))
            # an entry that no toxic text of this part holds matters only if another part's does
            both = {e: (n, seen[0].get(e, 0)) for e, n in seen[1].items()}
            both |= {e: (0, n) for e, n in seen[0].items() if e not in both}
            toxic, clean = zip(*both.values()) if both else ((), ())
            yield pa.RecordBatch.from_pydict(
                {"entry": pa.array(list(both), pa.string()), "toxic": pa.array(toxic, pa.int64()), "clean": pa.array(clean, pa.int64())}
            )

    counts = sample.mapInArrow(count, "entry string, toxic bigint, clean bigint").groupBy("entry")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic_docs + 1)) - F.log((F.col("clean") + 0.5) / (clean_docs + 1))
    expected = (F.col("toxic") + F.col("clean")) / (toxic_docs + clean_docs)
    part = lambda n, docs: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (expected * docs))).otherwise(0)
    ratio = 2 * (part("toxic", toxic_docs) + part("clean", clean_docs))
    telling = counts.where(F.col("toxic") >= LEAST_DOCS).withColumn("odds", odds).withColumn("ratio", ratio)
    rows = telling.where((F.col("odds") > LEAST_ODDS) & (F.col("ratio") > LEAST_RATIO))
    rows = rows.collect()
    weights: dict[str, float] = {}
    for row in sorted(rows, key=lambda r: (len(r.entry), r.entry)):
        shorter = [weights[row.entry[:k]] for k in range(3, len(row.entry)) if row.entry[:k] in weights]
        if not shorter or row.odds > max(shorter) + 1:  # a beginning says it all, or a longer one says more
            weights[row.entry] = float(row.odds)
    lexicon = Lexicon(weights)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, automaton = Folding(), lexicon.automaton()
        for part in slices(batches, "_text", TEXT_BYTES):
            seen = (Counter(), Counter())
            for t, toxic in zip(part.column("_text").to_pylist(), part.column("_toxic").to_pylist()):
                seen[toxic].update({p for _, *both in matches(folded(t, table), automaton) for p in both if " " in p})
            held = sorted(seen[0] | seen[1])
            counts = [pa.array([seen[k][p] for p in held], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), *counts], ["phrase", "clean", "toxic"])

    pairs = sample.mapInArrow(phrases, "phrase string, clean bigint, toxic bigint").groupBy("phrase")
    pairs = pairs.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    harmless = pairs.where((F.col("clean") >= 3) & (F.col("toxic") / toxic_docs < 0.2 * F.col("clean") / clean_docs))
    lexicon.exceptions = {r.phrase for r in harmless.select("phrase").collect()} | set(exceptions)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, automaton = Folding(), lexicon.automaton()
        for part in slices(batches, "_text", TEXT_BYTES):
            plain = [folded(t, table) for t in part.column("_text").to_pylist()]
            length = pa.array([t.count(" ") - 1 for t in plain], pa.int64())
            weight = pa.array([weight_of(t, automaton, lexicon.exceptions) for t in plain], pa.float64())
            yield pa.RecordBatch.from_arrays([part.column("_toxic"), length, weight], ["toxic", "length", "weight"])

    # three numbers for each row of the bounded sample
    found = sorted(map(tuple, sample.mapInArrow(weigh, "toxic int, length bigint, weight double").collect()))
    weight = np.array([r[2] for r in found])
    toxic = np.array([r[0] for r in found], float)
    importance = np.where(toxic == 1, numbers[1] / toxic_docs, numbers[0] / clean_docs)
    importance *= len(found) / importance.sum()
    lexicon.scale = _calibrate(weight, np.array([r[1] for r in found], float), toxic, importance)
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """All rows and columns of `docs` and a last column _score between 0 and 1; the name gets
    underscores behind it should `docs` have such a column.

    Null texts and texts without letters get the score of a text without matches. An empty
    table gives an empty result; ids may be null or repeat.
    """
    own, name = docs.columns, free(docs, "_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, automaton = Folding(), lexicon.automaton()
        for part in slices(batches, text, TEXT_BYTES):
            plain = [folded(t, table) for t in part.column(text).to_pylist()]
            weight = np.array([weight_of(t, automaton, lexicon.exceptions) for t in plain], float)
            length = np.array([t.count(" ") - 1 for t in plain], float)
            columns = [part.column(c) for c in own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lexicon.score(weight, length))], names=[*own, name])

    return docs.mapInArrow(run, extended(docs, **{name: "double"}))
