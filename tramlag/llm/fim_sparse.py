"""Fill-in-the-middle by a sparse exception index.

A text is cut at code points, but its bytes are what is copied. Only the characters of more
than one byte are indexed: their positions and the bytes in excess before each. A binary
search in that index turns a cut in code points into one in bytes and back; what lies between
the exceptions is ASCII, where both differ by a constant. One index serves a whole slice of
rows, whose texts lie one behind the other in an Arrow buffer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramlag.llm.common import extended, free, slices, utf8

#: Marks before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes of text that are handled at once; a longer text is handled alone.
SLICE = 8 << 20

RESULT = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"


class Exceptions:
    """Index of the multibyte characters in UTF-8 bytes; converts sorted or unsorted arrays of positions."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0) + (lead >= 0xF0)
        self.before = np.concatenate(([0], np.cumsum(excess, dtype=np.int64)))
        self.points = self.at - self.before[:-1]

    def to_points(self, at: np.ndarray) -> np.ndarray:
        """Code points before byte positions that lie between characters."""
        return at - self.before[np.searchsorted(self.at, at)]

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        """Bytes before the given numbers of code points."""
        return points + self.before[np.searchsorted(self.points, points)]


def draws(key: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of `seed:key`; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    into: str = "fim",
    seed: int = 1,
    fim_percent: int = 90,
    spm_percent: int = 20,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """`docs` with a last column `into` (`common.free(docs, into)`, should that name be taken):
    a struct of n (code points), form, prefix_chars, middle_chars and output.

    Texts are cut at two drawn places; the share `fim_percent` is written with its middle last,
    of these `spm_percent` suffix first. A text that is empty or null (treated as empty) or that
    holds a sentinel stays plain: output is the text, and prefix_chars and middle_chars are null.
    Draws depend on the key and the seed alone, so rows with equal keys are cut by equal draws,
    and a null key is a key like any other. Empty tables give empty tables.
    """
    name = free(docs, into)
    marks = [s.encode() for s in sentinels]
    found = re.compile(b"|".join(map(re.escape, marks)))
    schema = extended(docs, **{name: RESULT})
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE):
            drawn = [batch.column(width + i).to_numpy() for i in range(4)]
            data, offsets = utf8(batch.column(text))
            cut = _cuts(np.frombuffer(data, np.uint8), offsets, drawn)
            held = np.zeros(len(batch), bool)
            for hit in found.finditer(data):
                row = np.searchsorted(offsets, hit.start(), "right") - 1
                held[row] |= hit.end() <= offsets[row + 1]
            plain = (cut["n"] == 0) | held | (drawn[2] % 100 >= fim_percent)
            spm = ~plain & (drawn[3] % 100 < spm_percent)
            output = _written(data, offsets, cut["first"], cut["second"], plain, spm, marks)
            parts = [
                pa.array(cut["n"]),
                pa.array(np.where(plain, PLAIN, np.where(spm, SPM, PSM)), pa.string()),
                pa.array(cut["prefix"], pa.int64(), mask=plain),
                pa.array(cut["middle"], pa.int64(), mask=plain),
                output,
            ]
            made = pa.StructArray.from_arrays(parts, ["n", "form", "prefix_chars", "middle_chars", "output"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], made], names=schema.names)

    taken = docs
    for draw in draws(key, seed):
        taken = taken.select("*", draw.alias(free(taken, "draw")))
    return taken.mapInArrow(run, schema)


def _cuts(data: np.ndarray, offsets: np.ndarray, drawn: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Lengths in code points, and where prefix and middle end, in bytes of the slice."""
    index = Exceptions(data)
    starts = index.to_points(offsets)
    n = np.diff(starts)
    a, b = drawn[0] % (n + 1), drawn[1] % (n + 1)
    prefix, end = np.minimum(a, b), np.maximum(a, b)
    first, second = index.to_bytes(starts[:-1] + prefix), index.to_bytes(starts[:-1] + end)
    return {"n": n, "prefix": prefix, "middle": end - prefix, "first": first, "second": second}


def _written(data, offsets, first, second, plain, spm, marks) -> pa.Array:
    """Outputs of all rows, copied from the slice's bytes."""
    p, s, m = marks
    rows = []
    for begin, x, y, end, whole, back in zip(
        offsets.tolist(), first.tolist(), second.tolist(), offsets[1:].tolist(), plain.tolist(), spm.tolist()
    ):
        if whole:
            rows.append(data[begin:end])
        elif back:
            rows.append(b"".join((s, data[y:end], p, data[begin:x], m, data[x:y])))
        else:
            rows.append(b"".join((p, data[begin:x], s, data[y:end], m, data[x:y])))
    return pa.array(rows, pa.binary()).view(pa.string())


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text from an output and its form, whatever drew the cuts."""
    p, s, m = (r"\Q" + mark + r"\E" for mark in sentinels)
    psm = F.split(output, f"{p}|{s}|{m}")  # "", prefix, suffix, middle
    spm = F.split(output, f"{s}|{p}|{m}")  # "", suffix, prefix, middle
    return (
        F.when(form == PSM, F.concat(psm[1], psm[3], psm[2])).when(form == SPM, F.concat(spm[2], spm[3], spm[1])).otherwise(output)
    )
