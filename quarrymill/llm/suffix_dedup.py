"""Removal of byte strings that occur more than once, by suffix arrays built with the difference-cover algorithm.

The strings that can be equal are brought together by their anchors (see `repeats`): each task takes the distinct blocks
of whole anchors, lays them side by side and sorts their suffixes: those at places 1 and 2 modulo 3 by their first three
symbols, named and sorted again by recursion where names are not yet distinct, the others by one symbol and the rank
after it; then both are merged.  Recursion ends where equal names mean equal windows.  Neighbours in that order whose
first `window` bytes are equal are repeated.  Equal blocks are one entry with a mark that it has copies.

Anchors with very many distinct blocks are split once more, by a second anchor within the windows.

Edge cases: a null text is empty; a text shorter than a window loses nothing; of repeated rows each loses all its
windows; rows with equal or null ids are rows of their own; an empty table gives none.  Where a cut falls within a
character, `deduplicated` drops the bytes that are left of it; it returns other columns as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import kernels as K
from quarrymill.llm import repeats as R
from quarrymill.llm.work import Work, table, tidy, whole_groups

WINDOW, RUN = 200, 64
SHARD_BYTES = 600_000
VARIANTS = 4096
_SECOND = np.uint64(0xA0761D6478BD642F)


def _sorted_order(key: np.ndarray, bits: int) -> np.ndarray:
    """Stable order of keys of so many bits: the place is packed below the key where both fit."""
    places = max(1, (len(key) - 1).bit_length())
    if bits + places <= 63:
        packed = np.sort((key << places) | np.arange(len(key)))
        return packed & ((1 << places) - 1)
    return np.argsort(key, kind="stable")


def _names(key: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks from 1 of keys, given their order."""
    ranked = key[order]
    rank = np.cumsum(np.concatenate([[1], ranked[1:] != ranked[:-1]])) if len(key) else np.zeros(0, np.int64)
    out = np.empty(len(key), np.int64)
    out[order] = rank
    return out, int(rank[-1]) if len(rank) else 0


def suffix_array(s: np.ndarray, largest: int, need: int, reach: int = 1) -> np.ndarray:
    """Places of s in the order of their suffixes, as far as their first `need` bytes tell; a symbol has `reach` bytes.

    Symbols are 0 to `largest`; past the end stand zeros.
    """
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    bits = max(1, largest.bit_length())
    t = np.concatenate([s, np.zeros(5, np.int64)])
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    if 3 * bits <= 42:
        key = (t[sample] << 2 * bits) | (t[sample + 1] << bits) | t[sample + 2]
        order = _sorted_order(key, 3 * bits)
        names, many = _names(key, order)
    else:
        pair = (t[sample] << bits) | t[sample + 1]
        names, many = _names(pair, _sorted_order(pair, 2 * bits))
        key = (names << bits) | t[sample + 2]
        order = _sorted_order(key, many.bit_length() + bits)
        names, many = _names(key, order)
    if many < len(sample) and 3 * reach < need:
        order = suffix_array(names, many, need, 3 * reach)
    after = sample[order]  # the sampled suffixes in order
    rank = np.zeros(n + 5, np.int64)
    rank[after] = np.arange(1, len(after) + 1)
    wide = len(after).bit_length()
    zeros = np.arange(0, n, 3)
    head = (t[zeros] << wide) | rank[zeros + 1]
    by_head = _sorted_order(head, bits + wide)
    zeros, head = zeros[by_head], head[by_head]
    after = after[after < n]
    first, second = after[after % 3 == 1], after[after % 3 == 2]
    before = np.searchsorted((t[first] << wide) | rank[first + 1], head)
    if 2 * bits + wide <= 63:
        long = lambda x: (t[x] << (bits + wide)) | (t[x + 1] << wide) | rank[x + 2]
        before += np.searchsorted(long(second), long(zeros))
    else:
        pairs = np.concatenate([(t[x] << bits) | t[x + 1] for x in (second, zeros)])
        named, _ = _names(pairs, np.argsort(pairs, kind="stable"))
        key = (named << wide) | rank[np.concatenate([second, zeros]) + 2]
        before += np.searchsorted(key[: len(second)], key[len(second) :])
    out, taken = np.empty(n, np.int64), np.zeros(n, bool)
    # among suffixes that are equal as far as needed the ranks may disagree, within their common range
    at = np.maximum.accumulate(before) + np.arange(len(zeros))
    out[at], taken[at] = zeros, True
    out[~taken] = after
    return out


def repeated_windows(data: np.ndarray, starts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Marks the windows (starts[i] .. starts[i] + counts[i] - 1 for each block i) that occur again in `data`."""
    places = R.ranges(starts, counts)
    s = data.astype(np.int64) + 1
    inside = np.zeros(len(data), bool)
    inside[places] = True
    ends = starts + counts - 1 + window
    gap = np.ones(len(data) + 1, bool)
    for a, b in zip(starts.tolist(), ends.tolist()):
        gap[a:b] = False
    s[gap[:-1]] = 0
    order = suffix_array(s, 256, window)
    order = order[inside[order]]
    a, b = order[:-1], order[1:]
    live = np.arange(len(a))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), np.uint64, padded.tobytes(), strides=(1,)) if window >= 8 else None
    steps = [*range(0, window - 8, 8), window - 8] if eight is not None else range(window)
    for k in steps:
        x = eight if eight is not None else padded
        live = live[x[a[live] + k] == x[b[live] + k]]
    hit = np.zeros(len(data), bool)
    hit[a[live]] = hit[b[live]] = True
    return hit[places]


def _cut(window: int):
    """Of each text the listed blocks with their bytes; a hot anchor's blocks by second anchors."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, owner, fp, first, n, copy = R.block_columns(batch)
            hot = batch.column("hot").values.to_numpy(zero_copy_only=False) if "hot" in batch.schema.names else None
            hot = set() if hot is None else set(hot.tolist())
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            out: list[list] = [[], [], [], [], [], []]
            for i in range(len(uid)):
                a, m = int(first[i]), int(n[i])
                body = texts[owner[i]][a : a + m - 1 + window]
                pieces = [(int(fp[i]), 0, m)]
                if hot and int(fp[i]) in hot:
                    hashes = K.mix(K.byte_windows(np.frombuffer(body, np.uint8), RUN // 2) ^ _SECOND)
                    place = K.minimizers(hashes, window - RUN // 2 + 1)
                    cuts = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist(), m]
                    keys = K.mix(hashes[place] ^ K._U(int(fp[i]) & (2**64 - 1))).view(np.int64)
                    pieces = [(int(keys[x]), x, y - x) for x, y in zip(cuts, cuts[1:])]
                for key, x, y in pieces:
                    for column, value in zip(out, (key, int(uid[i]), a + x, y, bool(copy[i]), body[x : x + y - 1 + window])):
                        column.append(value)
                if len(out[0]) >= 8192:
                    yield _block_batch(out)
                    out = [[], [], [], [], [], []]
            if out[0]:
                yield _block_batch(out)

    return make


def _block_batch(out: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], ["fp", "uid", "first", "n", "copy", "body"])


def compared(cut: DataFrame, window: int, shard: int = SHARD_BYTES) -> DataFrame:
    """uid, first, n of the windows of blocks without copies that occur again."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "fp", 512):
            fp = group.column("fp").to_numpy()
            sizes = group.column("n").to_numpy() - 1 + window
            ends = np.append(np.flatnonzero(fp[1:] != fp[:-1]) + 1, len(fp))
            lone = np.diff(np.concatenate([[0], ends])) == 1
            total, start, cuts = np.cumsum(sizes), 0, []
            for e in ends.tolist():
                if total[e - 1] - (total[start - 1] if start else 0) >= shard:
                    cuts.append((start, e))
                    start = e
            cuts.append((start, len(fp)))
            alone = np.repeat(lone, np.diff(np.concatenate([[0], ends])))
            for x, y in cuts:
                rows = x + np.flatnonzero(~alone[x:y])
                if not len(rows):
                    continue
                part = group.take(pa.array(rows)).combine_chunks()
                data = np.frombuffer(b"\0".join(part.column("body").to_pylist()), np.uint8)
                counts = part.column("n").to_numpy()
                at = np.concatenate([[0], np.cumsum(counts + window)[:-1]])
                hit = repeated_windows(data, at, counts, window)
                copy = np.repeat(part.column("copy").to_numpy(zero_copy_only=False), counts)
                owner = np.repeat(np.arange(len(counts)), counts)
                place = R.ranges(part.column("first").to_numpy(), counts)
                on = np.flatnonzero(hit & ~copy)
                if not len(on):
                    continue
                new = np.ones(len(on), bool)
                new[1:] = (on[1:] != on[:-1] + 1) | (owner[on[1:]] != owner[on[:-1]])
                head = np.flatnonzero(new)
                uid = part.column("uid").to_numpy()[owner[on[head]]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid), pa.array(place[on[head]]), pa.array(np.diff(np.append(head, len(on))))], ["uid", "first", "n"]
                )

    dealt = cut.repartition("fp").sortWithinPartitions("fp")
    return dealt.mapInArrow(tidy(make), "uid bigint, first bigint, n bigint")


def repeated(work: Work, rows: DataFrame, window: int = WINDOW, run: int = RUN, variants: int = VARIANTS) -> DataFrame:
    """uid and `hits` of the documents that have repeated windows."""
    found = work.table(R.classified(R.ordered(R.occurrences(rows, R.byte_blocks, window, run))), "found")
    reps = found.where("rep")
    hot = reps.groupBy("fp").agg(F.count("*").alias("many")).where(F.col("many") > variants).select("fp")
    lists = reps.groupBy("uid").agg(F.collect_list(F.struct("fp", "first", "n", "copy")).alias("blocks"))
    if hot.limit(1).count():
        marked = reps.join(hot, "fp", "left_semi").groupBy("uid").agg(F.collect_set("fp").alias("hot"))
        lists = lists.join(marked, "uid", "left")
    cut = rows.select("uid", "text").join(lists, "uid").mapInArrow(
        tidy(_cut(window)), "fp bigint, uid bigint, first bigint, n bigint, copy boolean, body binary"
    )
    return R.intervals(found, work.table(compared(cut, window), "compared"))


DIGEST = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def digests(work: Work, docs: DataFrame, window: int = WINDOW, run: int = RUN, variants: int = VARIANTS) -> DataFrame:
    rows = R.keyed(work, docs)
    hits = repeated(work, rows, window, run, variants)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("hits").to_pylist()):
                spans = R.merged(found, window)
                kept, at = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(text[at:a])
                    at = b
                kept.update((text or b"")[at:])
                for column, x in zip(out, (len(text or b""), sum(b - a for a, b in spans), len(spans), kept.hexdigest())):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return R.with_hits(rows, hits).mapInArrow(make, DIGEST)


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with repeated strings cut out of `text`, and all their other columns; none is dropped."""
    work = Work(docs.sparkSession, "suffix-dedup")
    others = [c for c in docs.columns if c != "text"]
    rest = F.struct(*(F.col(f"`{c}`") for c in others)).alias("rest")
    rows = R.keyed(work, docs.select(rest, "doc_id", "text"), "rest")
    hits = work.table(repeated(work, rows.select("uid", "text"), window), "hits")
    work.drop("found", "compared")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("hits").to_pylist()):
                at, kept = 0, []
                for a, b in R.merged(found, window):
                    kept.append(text[at:a])
                    at = b
                texts.append(text if text is None else (b"".join(kept) + text[at:]).decode("utf-8", "ignore" if at else "strict"))
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(texts, pa.string())], ["rest", "text"])

    joined = rows.join(hits, "uid", "left").select("rest", "text", "hits")
    changed = joined.mapInArrow(tidy(make), joined.select("rest", "text").schema)
    return changed.select(*("text" if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "suffix-dedup")
    return work.result(digests(work, table(spark, sf_dir, "documents")))
