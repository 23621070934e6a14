"""Document fingerprints by improbable features.

Every byte window of a text has an entropy. Over all windows of all documents the entropies
are counted, and a window is the rarer the less often its entropy occurs. In each
neighbourhood of windows the rarest one wins; windows that win often enough are the features
of the text. Features are hashed into Bloom filters of a fixed size, a new one whenever the
last is full: the chain is the fingerprint. Two fingerprints are compared by the bits their
filters share, normalised between what chance gives and what equal filters give.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramlag.llm.common import slices, utf8, written

WINDOW = 24  # bytes of a feature, a multiple of 8
NEIGHBOURS = 32  # windows among which the rarest wins; a power of two
WINS = 12  # neighbourhoods that a feature has to win
LEVELS = 1_000  # steps in which entropies are counted
WEAK = 100  # windows of less entropy than this step win only where no other window is
BITS, HASHES, FULL = 2_048, 5, 160  # of a filter: bits, bits set by a feature, features held
SIGMAS = 3.0  # an overlap within so many standard deviations of chance counts as none
#: Bytes of text that are handled at once, and windows of a longer text's pieces.
SLICE = 1 << 20
CHUNK = 1 << 16  # bytes whose entropies are worked out at once, so that they stay in a core's cache
BLOCK = 512  # filters of one text that are compared at once

_TERMS = np.array([round(n * np.log2(n) * 2**20) if n else 0 for n in range(WINDOW + 1)], np.int64)
_GAIN = np.diff(_TERMS)  # by the count of a byte before one more of it

RESULT = """
    n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary,
    near_edited double, near_next double
"""


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Entropy of the window at each byte position, in steps of the greatest possible one.

    Sums of n log n over a window's bytes change by the byte that enters and the byte that
    leaves, given how often these occur in the window; such counts come from comparing the
    data with itself at every shift below the window's length.
    """
    found = np.empty(max(0, len(data) - WINDOW + 1), np.uint16)
    for begin in range(0, len(found), CHUNK):
        part = data[begin : begin + CHUNK + WINDOW - 1]
        before, after = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
        for shift in range(1, WINDOW):
            same = part[shift:] == part[:-shift]
            before[shift:] += same
            after[:-shift] += same
        sums = np.empty(len(part) - WINDOW + 1, np.int64)
        sums[0] = _GAIN[before[:WINDOW]].sum()
        sums[1:] = _GAIN[before[WINDOW:]] - _GAIN[after[: len(part) - WINDOW]]
        level = LEVELS - np.ceil(np.cumsum(sums) * (LEVELS / int(_TERMS[WINDOW])))
        found[begin : begin + CHUNK] = np.maximum(level, 0)
    return found


class Layout:
    """Texts side by side, in pieces that can be judged on their own.

    A piece of a long text repeats the neighbourhoods at its ends, so that every window is
    judged as in the whole text. Gaps keep pieces apart; a text shorter than a window is one
    window, padded with zeros.
    """

    def __init__(self, pieces: list[tuple[int, bytes, int, int]]):
        """Pieces: number of the text, bytes, first and end of the windows that it decides."""
        gap = bytes(NEIGHBOURS)
        rows, self.starts, at = [], [], 0
        for _, data, _, _ in pieces:
            data = data.ljust(WINDOW, b"\0")
            self.starts.append(at)
            rows += (data, gap)
            at += len(data) + len(gap)
        self.data = np.frombuffer(b"".join(rows), np.uint8)
        self.text = np.array([p[0] for p in pieces], np.int64)
        self.starts = np.array(self.starts, np.int64)
        self.windows = np.array([max(len(p[1]) - WINDOW, 0) + 1 for p in pieces], np.int64)
        self.first = self.starts + np.array([p[2] for p in pieces], np.int64)
        self.end = self.starts + np.array([p[3] for p in pieces], np.int64)

    def texts_at(self, at: np.ndarray) -> np.ndarray:
        """Numbers of the texts at positions."""
        return self.text[np.searchsorted(self.starts, at, "right") - 1]

    def inside(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which positions lie in one of the ranges, that come in order and do not overlap."""
        steps = np.zeros(len(self.data) + 1, np.int8)
        steps[begin] += 1
        np.add.at(steps, end, -1)
        return np.cumsum(steps[:-1], dtype=np.int8).astype(bool)


def pieces_of(texts: list[bytes]) -> Iterator[list[tuple[int, bytes, int, int]]]:
    """Pieces of the texts, in lists of about SLICE bytes; empty texts have none."""
    pieces, held = [], 0
    for number, text in enumerate(texts):
        windows = max(len(text) - WINDOW, 0) + 1 if text else 0
        for first in range(0, windows, SLICE):
            end = min(first + SLICE, windows)
            begin = max(0, first - NEIGHBOURS)
            piece = text[begin : end + NEIGHBOURS + WINDOW - 1]
            pieces.append((number, piece, first - begin, end - begin))
            held += len(piece)
            if held >= SLICE:
                yield pieces
                pieces, held = [], 0
    if pieces:
        yield pieces


def chosen(layout: Layout, levels: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the features, the windows that are rarest in WINS of their neighbourhoods;
    and of the rarest window of each piece that has no feature.

    Of equally rare windows the leftmost wins. A neighbourhood ends with its text.
    """
    none = np.iinfo(np.int64).max
    size = len(layout.data)
    at = np.flatnonzero(layout.inside(layout.starts, layout.starts + layout.windows))
    key = np.full(size + NEIGHBOURS, none)
    key[at] = (ranks[levels[at]] << 32) + at
    rarest = key
    shift = 1
    while shift < NEIGHBOURS:
        rarest = np.minimum(rarest, np.concatenate((rarest[shift:], np.full(shift, none))))
        shift *= 2
    wins = np.bincount(rarest[at] & 0xFFFFFFFF, minlength=size)
    found = (wins >= WINS) & layout.inside(layout.first, layout.end)
    upto = np.concatenate(([0], np.cumsum(found)))
    bare = np.flatnonzero(upto[layout.end] == upto[layout.first])
    spare = [key[layout.first[i] : layout.end[i]].min() & 0xFFFFFFFF for i in bare]
    return np.flatnonzero(found), np.array(spare, np.int64)


def hashes(windows: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of bytes."""
    value = np.full(len(windows), 0x9E3779B97F4A7C15, np.uint64)
    for word in np.ascontiguousarray(windows).view("<u8").T:
        value = (value ^ word) * np.uint64(0xFF51AFD7ED558CCD)
        value ^= value >> np.uint64(32)
    value *= np.uint64(0xC4CEB9FE1A85EC53)
    return value ^ value >> np.uint64(29)


def digests(texts: list[bytes], ranks: np.ndarray) -> list[bytes]:
    """Fingerprint of each text: number of its features (4 bytes), then its filters.

    A feature that a text repeats is inserted once. A text whose windows all win too seldom has
    its rarest window as feature, the leftmost of these; an empty text has no feature and no filter.
    """
    numbers, values, rarest = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], {}
    for pieces in pieces_of(texts):
        layout = Layout(pieces)
        levels = entropy_levels(layout.data)
        at, spare = chosen(layout, levels, ranks)
        windows = np.lib.stride_tricks.sliding_window_view(layout.data, WINDOW)
        numbers.append(layout.texts_at(at))
        values.append(hashes(windows[at]))
        for number, rank, value in zip(layout.texts_at(spare).tolist(), ranks[levels[spare]], hashes(windows[spare])):
            if number not in rarest or rank < rarest[number][0]:
                rarest[number] = rank, value
    bare = sorted(set(rarest).difference(*(n.tolist() for n in numbers)))
    number = np.concatenate((*numbers, np.array(bare, np.int64)))
    value = np.concatenate((*values, np.array([rarest[i][1] for i in bare], np.uint64)))
    own = np.argsort(number, kind="stable")
    number, value = number[own], value[own]
    order = np.lexsort((value, number))  # stable: equal features of a text stay in order
    again = np.zeros(len(order), bool)
    again[order[1:]] = (np.diff(number[order]) == 0) & (value[order][1:] == value[order][:-1])
    number, value = number[~again], value[~again]
    counts = np.bincount(number, minlength=len(texts))
    filters = -(-counts // FULL)
    ends = np.cumsum(filters)
    place = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
    row = np.repeat(ends - filters, counts) + place // FULL
    bits = np.zeros((int(ends[-1]) if len(ends) else 0, BITS), bool)
    wide = np.uint64(BITS.bit_length() - 1)
    for i in range(HASHES):
        bits[row, (value >> np.uint64(i) * wide & np.uint64(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return [
        int(n).to_bytes(4, "big") + packed[end - f : end].tobytes() for n, f, end in zip(counts, filters, ends.tolist())
    ]


def likeness(a: bytes, b: bytes) -> float:
    """How much of the fingerprint of fewer features lies in the other, 0 to 1.

    Each of its filters is held against all filters of the other, and its best match counts
    by the number of its features. Equal fingerprints, also those without features, give 1;
    one without features and one with some give 0.
    """
    if a == b:
        return 1.0
    if a[:4] > b[:4]:
        a, b = b, a
    n = int.from_bytes(a[:4], "big")
    if not n:
        return 0.0
    own, other = (np.frombuffer(x, np.uint8, offset=4).reshape(-1, BITS // 8) for x in (a, b))
    weight = np.full(len(own), FULL)
    weight[-1] = n - FULL * (len(own) - 1)
    strict = SIGMAS**2 + 2 * np.log(len(own) * len(other))  # the best of many comparisons has to stand out
    best = np.zeros(len(own))
    for i in range(0, len(own), BLOCK):
        mine = np.unpackbits(own[i : i + BLOCK], axis=1).astype(np.float32)
        sizes = mine.sum(1)[:, None]
        for j in range(0, len(other), BLOCK):
            theirs = np.unpackbits(other[j : j + BLOCK], axis=1).astype(np.float32)
            found = theirs.sum(1)[None, :]
            common = mine @ theirs.T
            chance = sizes * found / BITS
            spread = chance * (1 - sizes / BITS) * (1 - found / BITS)
            most = np.minimum(sizes, found)
            score = np.where((common - chance) ** 2 > strict * spread, (common - chance) / np.maximum(most - chance, 1e-9), 0)
            best[i : i + BLOCK] = np.maximum(best[i : i + BLOCK], score.max(1))
    return float(min(1.0, max(0.0, best @ weight / n)))


def rarity(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of each entropy level, 0 for the rarest, from all windows of all documents.

    Tasks count their own windows; 1,001 sums reach the driver. Levels are ranked by count,
    then level; weak levels come last. Null and empty texts have no window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LEVELS + 1, np.int64)
        for batch in slices(batches, "text", SLICE):
            for pieces in pieces_of(_texts(batch.column("text"))):
                layout = Layout(pieces)
                levels = entropy_levels(layout.data)
                at = layout.inside(layout.first, layout.end)[: len(levels)]
                counts += np.bincount(levels[at], minlength=LEVELS + 1)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"level": pa.array(seen, pa.int32()), "n": pa.array(counts[seen])})

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "level int, n bigint")
    counts = np.zeros(LEVELS + 1, np.int64)
    for level, n in found.groupBy("level").agg(F.sum("n")).collect():
        counts[level] = n
    levels = np.arange(LEVELS + 1)
    ranks = np.empty(LEVELS + 1, np.int64)
    ranks[np.lexsort((levels, counts, levels < WEAK))] = levels
    return ranks


def _texts(column: pa.Array) -> list[bytes]:
    data, offsets = utf8(column)
    cuts = offsets.tolist()
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def fingerprints(docs: DataFrame, ranks: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint binary) of every row; a null text counts as empty, other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            made = pa.array(digests(_texts(batch.column("text")), ranks), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), made], names=["id", "fingerprint"])

    taken = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return taken.mapInArrow(run, f"id {kind}, fingerprint binary").select(F.col("id").alias(key), "fingerprint")


def _edited(text: str, following: str) -> bytes:
    """`text` with its second half replaced by as many first characters of the next one."""
    half = len(text) // 2
    return (text[: len(text) - half] + following[:half]).encode()


def _compared(texts: list[str], own: list[bytes], following: list[str], nexts: list[bytes], ranks) -> dict[str, list]:
    edited = [_edited(a, b) for a, b in zip(texts, following)]
    made = digests(edited, ranks)
    return {
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited],
        "fingerprint": own,
        "edited_fingerprint": made,
        "near_edited": [likeness(a, b) for a, b in zip(own, made)],
        "near_next": [likeness(a, b) for a, b in zip(own, nexts)],
    }


def edit_audit(docs: DataFrame, ranks: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every row and of its edited text, and their likeness: (key, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has the last half of the characters replaced by the first as many (or all)
    of the next document, by descending key, rows without key last, rows of equal keys by a hash
    of their text; the first row follows the last. Null texts are empty ones; a row that is
    alone follows itself. Columns besides key and text are left out.

    Texts are shuffled once, into ranges of the key that are sorted; a task walks through its
    range with one document in hand. The first and the last row of each range are set down
    with their texts and paired across ranges afterwards.
    """
    kind = docs.schema[key].dataType.simpleString()
    columns = [c.split()[0] for c in RESULT.split(",")]
    schema = f"id {kind}, {RESULT}, place int, first boolean, text string"

    def rows(ids: list, results: dict[str, list], edge: tuple = (None, None, None)) -> pa.RecordBatch:
        places = dict(zip(("place", "first", "text"), ([v] * len(ids) for v in edge)))
        return pa.RecordBatch.from_pydict({"id": ids} | results | places, schema=layout)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        held = None  # the last row so far: id, text, fingerprint
        empty = {c: [None] for c in columns}
        for batch in slices(batches, "text", SLICE):
            ids = batch.column("id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            made = digests(_texts(batch.column("text")), ranks)
            if held is None:
                yield rows(ids[:1], empty | {"fingerprint": made[:1]}, (place, True, texts[0]))
            else:
                ids, texts, made = [held[0], *ids], [held[1], *texts], [held[2], *made]
            if len(ids) > 1:
                yield rows(ids[:-1], _compared(texts[:-1], made[:-1], texts[1:], made[1:], ranks))
            held = ids[-1], texts[-1], made[-1]
        if held:
            yield rows([held[0]], empty | {"fingerprint": [held[2]]}, (place, False, held[1]))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pair = [row["text"]], [row["fingerprint"]], [row["next_text"]], [row["next_fingerprint"]]
                yield rows([row["id"]], _compared(*pair, ranks))

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    layout = to_arrow_schema(StructType.fromDDL(schema))
    taken = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    order = F.col("id").desc_nulls_last(), F.xxhash64("text").asc()
    ranges = taken.repartitionByRange(*order).sortWithinPartitions(*order)
    walked = written(ranges.mapInArrow(walk, schema), "walked", compression="zstd")
    edges = walked.where("place is not null")
    everywhere = Window.partitionBy(F.lit(0))  # a row a range
    after = F.lead("place").over(everywhere.orderBy("place"))
    following = edges.where("first").select(
        F.col("place").alias("place"), F.coalesce(after, F.min("place").over(everywhere)).alias("next_place")
    )
    heads = edges.where("first").select(
        F.col("place").alias("next_place"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    lasts = edges.where("not first").select("id", "text", "fingerprint", "place")
    paired = lasts.join(following, "place").join(heads, "next_place")
    joined = paired.select("id", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(join, schema)
    closed = walked.where("place is null").unionByName(joined)
    return closed.select(F.col("id").alias(key), *columns)
