"""Substring dedup with a count-min prefilter.

Rows are dealt to chunks by a hash. A first pass over the chunks makes sketches of window counts;
merged by the owner of each segment of cells, they overestimate every window's count. The owner
answers each chunk, a bit a cell that the chunk sent. A second pass keeps the windows estimated as
repeated, and only these are grouped exactly. A window counted once is no repetition, and none that
repeats can be estimated below its count, so nothing is lost. Sketches grow with the input and
nothing of them passes through the driver; texts move once, to their chunks.

Windows are told apart by 96 bits of two independent multilinear hashes over 128-bit word
hashes. Both passes send columns of numbers packed by hash range, not a row per window; a
chunk of texts sends a window that it holds many times only for its smallest document, so
that a passage in a third of all documents is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramlag.llm.common import extended, free, slices, words_of

DEPTH = 2
#: log2 of the cells of a sketch row at least; it has about three cells a window.
LEAST_CELLS = 22
#: log2 of the cells that one group counts, a byte each: grows with the sketch between these bounds, so
#: that a chunk does not send a row a window.
SEGMENT, MOST_SEGMENT, SEGMENTS = 22, 26, 12
#: Windows that a chunk is aimed at.
CHUNK = 1 << 21
TEXT_BYTES = 3 << 20
#: Bits of a cell that are looked up before the cell is.
LOW = 22

_BLOBS = ("h1", "h2", "doc", "sig", "pos")
_TYPES = {"h1": np.uint64, "h2": np.uint32, "doc": np.int64, "sig": np.int64, "pos": np.uint32}


def hash_windows(rows: list[list[bytes]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(h1, h2, row, start) of all windows of `window` words that lie within one row."""
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    number = int(counts.sum()) - window + 1
    if number <= 0:
        empty = np.zeros(0, np.uint64)
        return empty, empty, np.zeros(0, np.int64), np.zeros(0, np.int64)
    coded = pa.array([w for row in rows for w in row], pa.binary()).dictionary_encode()
    digests = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.to_pylist()))
    halves = np.frombuffer(digests, "<u8").reshape(-1, 2)
    places = coded.indices.to_numpy()
    row = np.repeat(np.arange(len(rows)), counts)
    ends = np.cumsum(counts)
    inside = np.flatnonzero(np.arange(number) + window <= ends[row[:number]])
    sums = []
    for half in (0, 1):
        word, total = halves[:, half][places], np.zeros(number, np.uint64)
        for k in range(window):
            total += word[k : k + number] * np.uint64(xxhash.xxh64_intdigest(bytes([half, k % 256, k // 256])) | 1)
        total = total[inside]
        total ^= total >> np.uint64(32)
        sums.append(total * np.uint64(0x9E3779B97F4A7C15))
    row = row[inside]
    return sums[0], sums[1], row, inside - (ends - counts)[row]


def pack(cells: np.ndarray) -> bytes:
    """Sorted cells: their low bits side by side, then in unary how many share each number of high bits."""
    number = len(cells)
    size = int(cells[-1]).bit_length() if number else 0
    low = max(0, size - number.bit_length())
    high = (cells >> low).astype(np.int64)
    unary = np.zeros(number + (int(high[-1]) + 1 if number else 0), np.uint8)
    unary[high + np.arange(number)] = 1
    width = 2 if low <= 16 else 4
    rest = (cells & ((1 << low) - 1)).astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    rest = np.unpackbits(rest, axis=1, bitorder="little")[:, :low]
    head = np.array([number, low], "<u4").tobytes()
    return head + np.packbits(rest, bitorder="little").tobytes() + np.packbits(unary, bitorder="little").tobytes()


def unpack(blob: bytes) -> np.ndarray:
    number, low = (int(x) for x in np.frombuffer(blob, "<u4", 2))
    codes, ends = np.frombuffer(blob, np.uint8, offset=8), -(-number * low // 8)
    wide = np.zeros((number, 32), np.uint8)
    wide[:, :low] = np.unpackbits(codes[:ends], count=number * low, bitorder="little").reshape(number, low)
    rest = np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.int64)
    high = np.flatnonzero(np.unpackbits(codes[ends:], bitorder="little")) - np.arange(number)
    return (high << low) | rest


def by_segment(cells: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(segment, cells within it) of sorted cells, 2^size cells a segment."""
    of = (cells >> np.uint64(size)).astype(np.int64)
    begins = np.flatnonzero(np.diff(of, prepend=-1))
    for begin, part in zip(begins, np.split(cells, begins[1:]) if len(begins) else []):
        yield int(of[begin]), (part & np.uint64((1 << size) - 1)).astype(np.int64)


def planes(values: np.ndarray) -> bytes:
    """First bytes of all numbers, then second ones: what hardly varies lies together and compresses."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes() if len(values) else b""


def _concat(blobs, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    parts = (np.frombuffer(b, np.uint8).reshape(size, -1).T.copy().view(kind).ravel() for b in blobs if len(b))
    return np.concatenate([np.zeros(0, kind), *parts])


_SENT = pa.schema([("chunk", pa.int64()), ("depth", pa.int32()), ("segment", pa.int64()), ("cells", pa.binary())])
_TOLD = pa.schema([("chunk", pa.int64()), ("depth", pa.int32()), ("segment", pa.int64()), ("bits", pa.binary())])
_KEPT = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("local", pa.bool_()), *((n, pa.binary()) for n in _BLOBS)])
SENT = "chunk bigint, depth int, segment bigint, cells binary"
TOLD = "chunk bigint, depth int, segment bigint, bits binary"
KEPT = "chunk bigint, bucket bigint, local boolean, " + ", ".join(f"{n} binary" for n in _BLOBS)


class Names:
    """Columns of the placed rows, and the window."""

    def __init__(self, doc: str, sig: str, text: str, window: int):
        self.doc, self.sig, self.text, self.window = doc, sig, text, window

    def windows(self, rows: pa.Table):
        """Parts of the rows that have an id, with the hashes of their windows."""
        for part in slices(rows.to_batches(), self.text, TEXT_BYTES):
            part = part.filter(part.column(self.doc).is_valid())
            yield part, hash_windows([words_of(t.as_py()) for t in part.column(self.text)], self.window)


def sketches(placed: DataFrame, chunk: str, names: Names, bits: int, size: int) -> DataFrame:
    """(chunk, depth, segment, bits): of the cells that a chunk has windows in, in rising order, those that the
    merged sketches count twice or more."""
    shift = np.uint64(64 - bits)

    def partial(key: tuple, rows: pa.Table) -> pa.Table:
        held = [tuple(h >> shift for h in hashes[:2]) for _, hashes in names.windows(rows)]
        out: list[tuple] = []
        for depth in range(DEPTH if held else 0):
            cells = np.sort(np.concatenate([x[depth] for x in held]))
            few = np.ones(len(cells), bool)
            few[2:] = cells[2:] != cells[:-2]  # a third makes no difference
            out += [(key[0].as_py(), depth, segment, pack(own)) for segment, own in by_segment(cells[few], size)]
        return _table(out, _SENT)

    def owner(key: tuple, rows: pa.Table) -> pa.Table:
        counts = np.zeros(1 << size, np.uint8)
        blobs = rows.column("cells").to_pylist()
        for blob in blobs:
            cells = unpack(blob)
            first = np.diff(cells, prepend=-1) > 0
            for once in (cells[first], cells[~first]):
                counts[once] = np.minimum(counts[once] + 1, 2)
        depth, segment = (k.as_py() for k in key)
        out = []
        for chunk_of, blob in zip(rows.column("chunk").to_pylist(), blobs):
            cells = unpack(blob)
            own = counts[cells[np.diff(cells, prepend=-1) > 0]] > 1
            out.append((chunk_of, depth, segment, np.packbits(own).tobytes()))
        return _table(out, _TOLD)

    sent = placed.groupBy(chunk).applyInArrow(partial, SENT)
    return sent.groupBy("depth", "segment").applyInArrow(owner, TOLD)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def survivors(placed: DataFrame, chunk: str, names: Names, told: DataFrame, bits: int, size: int, buckets: int) -> DataFrame:
    """Windows estimated as repeated, packed by chunk and hash range.

    Of a window that a chunk holds in several documents, only those of the smallest go on; the
    others are decided here (`local`).
    """
    shift = np.uint64(64 - bits)

    def repeated(cells: np.ndarray, depth: int, told: dict[tuple[int, int], bytes]) -> np.ndarray:
        """Those of a chunk's cells that the sketches count twice or more."""
        cells, found = np.sort(cells), []
        cells = cells[np.r_[True, cells[1:] != cells[:-1]]]
        for segment, own in by_segment(cells, size):
            answer = np.frombuffer(told[depth, segment], np.uint8)
            if len(answer) != -(-len(own) // 8):
                raise RuntimeError("a chunk has other texts than in the first pass")
            some = own[np.unpackbits(answer, count=len(own)) > 0]
            found.append(some.astype(np.uint64) | np.uint64(segment << size))
        return np.concatenate([np.zeros(0, np.uint64), *found])

    def among(cells: np.ndarray, some: np.ndarray) -> np.ndarray:
        hit = np.zeros(len(cells), bool)
        if len(some):
            # most are ruled out by their low bits
            low = np.uint64((1 << LOW) - 1)
            seen = np.zeros(1 << LOW, bool)
            seen[some & low] = True
            maybe = np.flatnonzero(seen[cells & low])
            own = cells[maybe]
            hit[maybe] = some[np.minimum(np.searchsorted(some, own), len(some) - 1)] == own
        return hit

    def flush(chunk_of: int, h1, h2, doc, sig, pos) -> list[tuple]:
        order = np.lexsort((doc, h2, h1))
        h1, h2, doc, sig, pos = (x[order] for x in (h1, h2, doc, sig, pos))
        first = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        later = doc > doc[first][np.cumsum(first) - 1]
        out = []
        if later.any():
            rest = (x[later][np.lexsort((pos[later], doc[later]))] for x in (doc, sig, pos))
            out.append((chunk_of, chunk_of % buckets, True, b"", b"", *map(planes, rest)))
        h1, h2, doc, sig, pos = (x[~later] for x in (h1, h2, doc, sig, pos))
        of = (h1 >> np.uint64(32)).astype(np.int64) * buckets >> 32
        begins = np.flatnonzero(np.diff(of, prepend=-1))
        parts = zip(*(np.split(x, begins[1:]) for x in (h1, h2, doc, sig, pos)))
        return out + [(chunk_of, int(b), False, *map(planes, part)) for b, part in zip(of[begins], parts)]

    def second(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        held, docs, sigs, number = [], [], [], 0
        for part, (h1, h2, row, pos) in names.windows(rows):
            held.append((h1, h2, (row + number).astype(np.int32), pos.astype(np.uint32)))
            docs.append(part.column(names.doc).to_numpy(zero_copy_only=False).astype(np.int64))
            sigs.append(part.column(names.sig).to_numpy(zero_copy_only=False).astype(np.int64))
            number += part.num_rows
        if not sum(len(x[0]) for x in held):
            return _table([], _KEPT)
        h1, h2, row, pos = (np.concatenate(x) for x in zip(*held))
        held.clear()
        told = dict(zip(zip(*(answers.column(c).to_pylist() for c in ("depth", "segment"))), answers.column("bits").to_pylist()))
        keep = np.arange(len(h1))
        for depth, h in enumerate((h1, h2)):
            cells = h >> shift
            keep = keep[among(cells[keep], repeated(cells, depth, told))]
        if not len(keep):
            return _table([], _KEPT)
        row = row[keep]
        doc, sig = np.concatenate(docs)[row], np.concatenate(sigs)[row]
        return _table(flush(key[0].as_py(), h1[keep], (h2[keep] >> np.uint64(32)).astype(np.uint32), doc, sig, pos[keep]), _KEPT)

    return placed.groupBy(chunk).cogroup(told.groupBy("chunk")).applyInArrow(second, KEPT)


def _grouped(frame: pd.DataFrame) -> pd.DataFrame:
    """One hash range: what a smaller document holds as well, back to the chunks it came from."""
    out = frame.loc[frame["local"], ["chunk", "doc", "sig", "pos"]]
    frame = frame[~frame["local"]].reset_index(drop=True)
    if len(frame):
        h1, h2, doc, sig, pos = (_concat(frame[n], _TYPES[n]) for n in _BLOBS)
        chunk = np.repeat(frame["chunk"].to_numpy(np.int64), [len(b) // 8 for b in frame["h1"]])
        order = np.lexsort((doc, h2, h1))
        h1, h2, doc, sig, pos, chunk = (x[order] for x in (h1, h2, doc, sig, pos, chunk))
        first = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        later = np.flatnonzero(doc > doc[first][np.cumsum(first) - 1])
        later = later[np.lexsort((pos[later], doc[later], chunk[later]))]
        if len(later):
            begins = np.flatnonzero(np.r_[True, np.diff(chunk[later]) != 0])
            split = lambda x: [planes(y) for y in np.split(x[later], begins[1:])]
            more = {"chunk": chunk[later][begins], "doc": split(doc), "sig": split(sig), "pos": split(pos)}
            out = pd.concat([out, pd.DataFrame(more)])
    return out


def spans_of(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted starts of windows -> (begin, end) of the runs of words that they cover."""
    fresh = np.r_[True, np.diff(starts) > window]
    return starts[fresh], np.r_[starts[:-1][fresh[1:]], starts[-1]] + window


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = 13) -> DataFrame:
    """All rows and columns of `docs` with _n_words, _n_removed and _kept (kept words joined by one space).

    Every word goes that is covered by a window of `window` words whose sequence also starts in
    a row with a smaller id. Windows are judged on the input. Null texts and texts below
    `window` words lose nothing; null gives an empty _kept. Rows that share an id do not take
    words from one another. Rows with a null id neither lose nor take words. An empty table
    gives an empty result. A new name gets underscores behind it should `docs` have such a column.
    """
    doc, sig, chunk = (free(docs, f"_{c}") for c in ("doc", "sig", "chunk"))
    added = [free(docs, f"_{c}") for c in ("n_words", "n_removed", "kept")]
    own = docs.columns
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    windows = max(1, size // 6)
    bits = max(LEAST_CELLS, int(np.ceil(np.log2(3 * windows))))
    segment = int(np.clip(bits - SEGMENTS, SEGMENT, MOST_SEGMENT))
    buckets = max(64, 1 << int(windows >> 20).bit_length())
    wide = docs.withColumn(doc, F.col(id_column).cast("bigint"))
    repeated = wide.where(F.col(doc).isNotNull()).groupBy(doc).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    shared = not repeated.isEmpty()
    # rows that share an id are told apart by their text; else the column is constant
    wide = wide.withColumn(sig, F.xxhash64(F.col(text)) if shared else F.lit(0).cast("bigint"))
    # rows without an id, and equal rows of one id, may be any number: they are spread by their place
    place = F.monotonically_increasing_id()
    spread = place if shared else F.when(F.col(doc).isNull(), place).otherwise(F.lit(0).cast("bigint"))
    number = -(-windows // CHUNK)
    placed = wide.withColumn(chunk, F.pmod(F.xxhash64(doc, text, spread), F.lit(number))).repartition(chunk)
    names = Names(doc, sig, text, window)
    told = sketches(placed, chunk, names, bits, segment)
    found = survivors(placed, chunk, names, told, bits, segment, buckets)
    found = found.groupBy("bucket").applyInPandas(_grouped, "chunk bigint, doc binary, sig binary, pos binary")
    schema = extended(docs, **dict(zip(added, ("bigint", "bigint", "string"))))

    def cut(rows: pa.Table, found: pa.Table) -> pa.Table:
        spans = {}
        if found.num_rows:
            of, by, pos = (_concat(found.column(n).to_pylist(), _TYPES[n]) for n in ("doc", "sig", "pos"))
            order = np.lexsort((pos, by, of))
            of, by, pos = of[order], by[order], pos[order].astype(np.int64)
            begins = np.flatnonzero(np.r_[True, (np.diff(of) != 0) | (np.diff(by) != 0)])
            keys = zip(of[begins].tolist(), by[begins].tolist())
            spans = {key: spans_of(x, window) for key, x in zip(keys, np.split(pos, begins[1:]))}
        lost, out = set(spans), []
        for part in slices(rows.to_batches(), text, TEXT_BYTES):
            numbers, removed, kept = [], [], []
            for t, *key in zip(*(part.column(c).to_pylist() for c in (text, doc, sig))):
                words = words_of(t)
                numbers.append(len(words))
                if tuple(key) in spans:
                    lost.discard(tuple(key))
                    stay, at = [], 0
                    for begin, end in zip(*(x.tolist() for x in spans[tuple(key)])):
                        stay += words[at:begin]
                        at = end
                    words = stay + words[at:]
                removed.append(numbers[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            columns = [part.column(c) for c in own]
            columns += [pa.array(numbers, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            out.append(pa.RecordBatch.from_arrays(columns, names=[*own, *added]))
        if lost:
            raise RuntimeError("a chunk has other texts than in the passes before")
        return pa.Table.from_batches(out)

    return placed.groupBy(chunk).cogroup(found.groupBy("chunk")).applyInArrow(cut, schema)
