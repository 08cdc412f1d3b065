"""Windows that occur more than once anywhere: what substring and suffix-array deduplication have in common.

A window is `window` consecutive units (words or bytes) of one document.  Its anchor is the smallest of the hashes of
its runs of `run` units, the leftmost of equal ones: equal windows have equal anchors at equal places.  The windows of
one document that share an anchor's place are a block, so that an occurrence of an anchor stands for many windows, and
anchors that occur once drop their windows without a look at them.  No window is lost by that.

Occurrences are dealt by ranges of (anchor, block, document) and read in order.  Equal blocks lie side by side, and all
their windows are repeated; of each distinct block of an anchor with several, one goes on to be compared window by
window.  Ranges split a hot anchor over tasks: the groups at a range's borders, whose other rows may lie next door, go
on to that comparison in any case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm import kernels as K
from quarrymill.llm.work import Work, tidy

OCCURRENCE = "fp bigint, block bigint, uid bigint, first bigint, n bigint"
FOUND = "copy boolean, rep boolean, " + OCCURRENCE
_ORDER = ("fp", "block", "uid", "first")


def keyed(work: Work, docs: DataFrame, *further: str) -> DataFrame:
    """doc_id, text and a key `uid` for each row: doc_id where it tells all rows apart, else a number that is stored."""
    rows = docs.select(*further, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counts = rows.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if counts[0] == counts[1]:
        return rows.withColumn("uid", F.col("doc_id"))
    return work.table(rows.withColumn("uid", F.monotonically_increasing_id()), "keyed")


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + counts[i] - 1, one range after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def blocks(hashes, sums, base, lo, hi, window: int, run: int):
    """Blocks of windows: document, first window (within the document), number, anchor and content hash."""
    none = np.zeros(0, np.int64)
    places = K.minimizers(hashes, window - run + 1)
    counts = np.maximum(hi - lo - window + 1, 0)
    starts = ranges(lo, counts)
    if not len(starts):
        return none, none, none, none, none
    owner, place = np.repeat(np.arange(len(lo)), counts), places[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    first, n = starts[at], np.diff(np.append(at, len(starts)))
    block = K.spans(sums, base, first, first + n - 1 + window) ^ K.mix((place[at] - first).astype(np.uint64) + K._U(1))
    return owner[at], first - lo[owner[at]], n, hashes[place[at]].view(np.int64), block.view(np.int64)


def word_blocks(part: K.Slice, window: int, run: int):
    starts, ends, lo, hi = part.words()
    hashes = part.word_hashes(starts, ends)
    return blocks(K.word_windows(hashes, run), K.prefix(hashes, K._WORD_BASE), K._WORD_BASE, lo, hi, window, run)


def byte_blocks(part: K.Slice, window: int, run: int):
    sums = K.prefix(K._BYTES[part.data], K._BASE)
    return blocks(K.byte_windows(part.data, run), sums, K._BASE, part.lo, part.hi, window, run)


def occurrences(rows: DataFrame, kind: Callable, window: int, run: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column("uid").to_numpy()
            for part in K.slices(batch.column("text")):
                owner, first, n, fp, block = kind(part, window, run)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (fp, block, uids[part.row + owner], first, n)], ["fp", "block", "uid", "first", "n"]
                )

    return rows.select("uid", "text").mapInArrow(tidy(make), OCCURRENCE)


def ordered(found: DataFrame) -> DataFrame:
    return found.repartitionByRange(*_ORDER[:3]).sortWithinPartitions(*_ORDER)


class _Sorted:
    """Reads occurrences in order; holds one row back, since a row's group shows by the row after it."""

    def __init__(self):
        self.held: list[np.ndarray] | None = None
        self.copied = self.several = False
        self.edge = None

    def feed(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        fresh = self.held is None
        if fresh:
            self.edge = rows[0][0]
        else:
            rows = [np.concatenate(x) for x in zip(self.held, rows)]
        fp, block = rows[0], rows[1]
        m = len(fp)
        at = np.arange(m)
        new_fp, new_block = np.ones(m, bool), np.ones(m, bool)
        new_fp[1:] = fp[1:] != fp[:-1]
        new_block[1:] = new_fp[1:] | (block[1:] != block[:-1])
        copy = ~new_block
        copy[:-1] |= ~new_block[1:]
        fp_start = np.maximum.accumulate(np.where(new_fp, at, 0))
        several = np.maximum.accumulate(np.where(new_block, at, 0)) > fp_start
        if not fresh:
            copy[0] |= self.copied
            several |= self.several & (fp_start == 0)
        rep = np.zeros(m, bool)
        rep[:-1] = new_block[1:] & (several[:-1] | ~new_fp[1:] | (fp[:-1] == self.edge))
        self.held, self.copied, self.several = [x[-1:] for x in rows], bool(copy[-1]), bool(several[-1])
        keep = np.flatnonzero(copy[:-1] | rep[:-1])
        return [copy[keep], rep[keep], *(x[keep] for x in rows)]

    def finish(self) -> list[np.ndarray]:
        if self.held is None:
            return []
        return [np.array([self.copied]), np.array([True]), *self.held]


def classified(found: DataFrame) -> DataFrame:
    """Of occurrences in order: `copy` rows, all of whose windows are repeated, and `rep` rows, which are to be compared.

    `part`, if there, tells the sorted files apart.
    """
    names = ["copy", "rep", "fp", "block", "uid", "first", "n"]
    parted = "part" in found.columns

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now = _Sorted(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy() for c in names[2:]]
            marks = batch.column("part").to_numpy() if parted else np.zeros(batch.num_rows, np.int64)
            cuts = [0, *(np.flatnonzero(marks[1:] != marks[:-1]) + 1).tolist(), len(marks)]
            for a, b in zip(cuts, cuts[1:]):
                out = []
                if now is not None and marks[a] != now:
                    out.append(reader.finish())
                    reader = _Sorted()
                now = marks[a]
                out.append(reader.feed([x[a:b] for x in rows]))
                for x in out:
                    yield pa.RecordBatch.from_arrays([pa.array(y) for y in x], names)
        if last := reader.finish():
            yield pa.RecordBatch.from_arrays([pa.array(y) for y in last], names)

    return found.mapInArrow(tidy(make), FOUND)


def bodies(rows: DataFrame, reps: DataFrame, make: Callable, schema: str) -> DataFrame:
    """Joins the blocks to be compared to their texts; `make` gets each batch with a list `blocks` for each text."""
    lists = reps.groupBy("uid").agg(F.collect_list(F.struct("fp", "first", "n", F.col("copy"))).alias("blocks"))
    return rows.select("uid", "text").join(lists, "uid").mapInArrow(make, schema)


def block_columns(batch: pa.RecordBatch):
    """uid, owner row, fp, first, n and copy of the listed blocks."""
    lists = batch.column("blocks")
    bounds = lists.offsets.to_numpy()
    flat = [x.slice(bounds[0], bounds[-1] - bounds[0]) for x in lists.values.flatten()]
    owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
    fp, first, n = (x.to_numpy() for x in flat[:3])
    return batch.column("uid").to_numpy()[owner], owner, fp, first, n, flat[3].to_numpy(zero_copy_only=False)


def intervals(found: DataFrame, compared: DataFrame) -> DataFrame:
    """Per document the list of (first, n): ranges of repeated windows."""
    every = found.where("copy").select("uid", "first", "n").unionByName(compared.select("uid", "first", "n"))
    return every.groupBy("uid").agg(F.collect_list(F.struct("first", "n")).alias("hits"))


def merged(hits: list[dict] | None, window: int) -> list[tuple[int, int]]:
    """The maximal ranges of units that windows cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((h["first"], h["first"] + h["n"] - 1 + window) for h in hits or ()):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def with_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    return rows.join(hits, "uid", "left").select("uid", "doc_id", "text", "hits")
