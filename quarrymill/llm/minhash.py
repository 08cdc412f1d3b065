"""Near-duplicate documents by b-bit MinHash.

Each document's distinct shingles give 128 minima.  Bands of four minima make buckets; only the low four bits of each
minimum are kept, packed, and in a bucket's task the similarity of its members is estimated by counting equal bit
groups and correcting for those equal by chance.  Members that may be similar enough are linked loosely; the components
of loose links then get their texts, and links are confirmed on whole sets.  Documents with equal sets are one row up
to that point.  Large buckets and components are dealt to tasks by pairs of blocks (`groups.in_blocks`); of links
within a task only those that span its components leave it.

Two documents at the similarity of 0.8 share no bucket with a probability of (1 - 0.8**4)**32, 5e-8, and are estimated
below the bound of 0.58, six standard errors away, with one below 1e-8; no other link can be lost.

Edge cases: a document without words, or a null text, has no shingles and stands alone; one with fewer words than a
shingle has them as its only one; repeated rows are linked; rows with equal or null ids are rows of their own, of which
one stays; very long texts are one row like others; `deduplicated` returns other columns as they are, whatever their names;
an empty table gives none.
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
from quarrymill.llm.groups import in_blocks, local_roots, with_smallest
from quarrymill.llm.work import Work, components, table, tidy, whole_groups

HASHES, BANDS, BITS = 128, 32, 4
BUCKET_ROWS = 2048
GROUP_SHINGLES = 1_000_000
LOOSE = 0.58
_R = np.random.default_rng(20)
_TIMES = _R.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _R.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingle_sets(part: K.Slice, width: int) -> list[np.ndarray]:
    """Sorted hashes of each document's distinct shingles."""
    starts, ends, lo, hi = part.words()
    hashes = part.word_hashes(starts, ends, lower=True)
    windows = K.word_windows(hashes, width)
    sums = K.prefix(hashes, K._WORD_BASE)
    out = []
    for a, b in zip(lo.tolist(), hi.tolist()):
        if b - a >= width:
            out.append(np.unique(windows[a : b - width + 1]))
        elif b > a:
            out.append(K.spans(sums, K._WORD_BASE, np.array([a]), np.array([b])))
        else:
            out.append(windows[:0])
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(high), 1024):
        np.minimum(out, (high[i : i + 1024, None] * _TIMES + _PLUS).min(0), out=out)
    return out


def packed(low: np.ndarray) -> np.ndarray:
    """Low bits of minima (rows of HASHES), two to a byte."""
    bits = (low & np.uint32(15)).astype(np.uint8)
    return bits[:, ::2] | (bits[:, 1::2] << 4)


def estimated(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity estimates of packed rows, by bit counts, less what is equal by chance."""
    z = x ^ y
    z |= z >> np.uint64(2)
    z |= z >> np.uint64(1)
    differ = np.bitwise_count(z & np.uint64(0x1111111111111111)).sum(-1, dtype=np.int64)
    chance = 1 / (1 << BITS)
    return ((HASHES - differ) / HASHES - chance) / (1 - chance)


SIGNATURE = "uid bigint, n bigint, key1 bigint, key2 bigint, bits binary, bands array<bigint>"


def signatures(rows: DataFrame, width: int) -> DataFrame:
    bands = np.arange(BANDS, dtype=np.uint64)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column("uid").to_numpy()
            for part in K.slices(batch.column("text")):
                sets = shingle_sets(part, width)
                low = np.stack([minima(x) for x in sets])
                pairs = low.view(np.uint64).reshape(len(sets), BANDS, 2)
                keys = K.mix(K.mix(pairs[:, :, 0] + bands * np.uint64(0x9E3779B97F4A7C15)) ^ pairs[:, :, 1])
                names = np.stack([np.frombuffer(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), "<i8") for x in sets])
                at = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(uids[part.row : part.row + part.n]), pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array([x.tobytes() for x in packed(low)], pa.binary()),
                        pa.ListArray.from_arrays(at, pa.array(keys.view(np.int64).ravel())),
                    ],
                    ["uid", "n", "key1", "key2", "bits", "bands"],
                )

    return rows.select("uid", "text").mapInArrow(tidy(make), SIGNATURE)


def _roots_batch(ids: list[np.ndarray], roots: list[np.ndarray]) -> pa.RecordBatch:
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ids, roots))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def loose_links(buckets: DataFrame, percent: int) -> DataFrame:
    """(a, b): rows of a bucket's task and the first row of it that links estimated at LOOSE or more reach."""

    def near(x, y, n, m):
        return (estimated(x, y) >= LOOSE) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "task", 4096):
            task, uid, n = (group.column(c).to_numpy() for c in ("task", "uid", "n"))
            bits = np.frombuffer(b"".join(group.column("bits").to_pylist()), np.uint64).reshape(len(uid), -1)
            cuts = np.concatenate([[0], np.flatnonzero(task[1:] != task[:-1]) + 1, [len(task)]])
            two = cuts[:-1][np.diff(cuts) == 2]
            two = two[near(bits[two], bits[two + 1], n[two], n[two + 1])]
            ids, roots = [uid[two + 1]], [uid[two]]
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                if b - a > 2:
                    links = np.zeros((b - a, b - a), bool)
                    for i in range(a, b, 64):
                        j = min(b, i + 64)
                        links[i - a : j - a] = near(bits[i:j, None], bits[None, a:b], n[i:j, None], n[None, a:b])
                    root = local_roots(links)
                    off = np.flatnonzero(root != np.arange(b - a))
                    ids.append(uid[a + off])
                    roots.append(uid[a + root[off]])
            yield _roots_batch(ids, roots)

    return buckets.repartition("task").sortWithinPartitions("task", "uid").mapInArrow(tidy(make), "a bigint, b bigint")


def set_roots(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the first that links (100 * common >= percent * all) reach."""
    m = len(sets)
    sizes = np.array([len(x) for x in sets])
    if m == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([0, 0 if 100 * common >= percent * (sizes.sum() - common) else 1])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every = every[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    del every
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(new)))
    name = np.empty(len(order), np.int32)
    name[order] = np.cumsum(new, dtype=np.int32) - 1
    owners = np.repeat(np.arange(m, dtype=np.int32), sizes)[order]
    del order, new
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    root = np.arange(m)
    for u in range(m):
        mine = name[bounds[u] : bounds[u + 1]]
        mine = mine[counts[mine] > 1]
        common = np.bincount(owners[R.ranges(starts[mine], counts[mine])], minlength=m)
        near = np.flatnonzero(100 * common >= percent * (sizes[u] + sizes - common))
        joined = np.unique(root[np.append(near, u)])
        if len(joined) > 1:
            root[np.isin(root, joined)] = joined[0]
            if not root.any():
                break
    return root


def confirmed_links(groups: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): rows of a task and the first row of it that links of whole sets reach."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "task", 64):
            task, uid = (group.column(c).to_numpy() for c in ("task", "uid"))
            cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
            sets: list[np.ndarray] = []
            for part in K.slices(group.column("text")):
                sets += shingle_sets(part, width)
            ids, roots = [], []
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    root = set_roots(sets[a:b], percent)
                    off = np.flatnonzero(root != np.arange(b - a))
                    ids.append(uid[a + off])
                    roots.append(uid[a + root[off]])
            yield _roots_batch(ids, roots)

    return groups.repartition("task").sortWithinPartitions("task", "uid").mapInArrow(tidy(make), "a bigint, b bigint")


def near_duplicates(work: Work, rows: DataFrame, width: int, percent: int, bucket_rows: int = BUCKET_ROWS,
                    group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """Per row of (uid, doc_id, text): uid, doc_id, n_shingles, component_id, kept, and stays, one row of each component."""
    signed = work.table(signatures(rows, width), "signatures")
    keys = ["key1", "key2"]
    copies = signed.where("n > 0").groupBy(*keys).agg(F.min("uid").alias("rep"))
    members = work.table(signed.select("uid", "n", *keys).join(copies, keys, "left").select(
        "uid", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("uid")).alias("rep")
    ), "members")
    reps = members.where("uid = rep and n > 0").select("uid")
    signed = work.table(signed.join(reps, "uid", "left_semi").drop(*keys), "reps")
    work.drop("signatures")

    each = signed.select("uid", F.explode("bands").alias("bucket"))
    full = each.groupBy("bucket").agg(F.count("*").alias("many")).where("many > 1")
    shared = work.table(each.join(full, "bucket"), "shared")
    dealt = in_blocks(shared, "bucket", "uid", F.ceil(F.col("many") / bucket_rows)).select("task", "uid")
    loose = loose_links(dealt.join(signed.select("uid", "n", "bits"), "uid"), percent)
    loose = work.table(components(work, loose, "loose"), "loosely")
    work.drop("shared")

    inside = loose.select(F.col("node").alias("uid"), "root").unionByName(loose.select(F.col("root").alias("uid"), "root").distinct())
    inside = work.table(inside.join(signed.select("uid", "n"), "uid"), "inside")
    sizes = inside.groupBy("root").agg(F.sum("n").alias("shingles"))
    tasks = in_blocks(inside.join(sizes, "root"), "root", "uid", F.ceil(F.col("shingles") / group_shingles)).select("task", "uid")
    links = confirmed_links(tasks.join(rows.select("uid", "text"), "uid"), width, percent)
    linked = components(work, work.table(links, "links"), "linked")

    rooted = members.join(linked, members.rep == linked.node, "left").select(
        "uid", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("root")
    )
    rooted = work.table(rooted, "rooted")
    rooted = work.table(rooted.join(rows.select("uid", "doc_id"), "uid"), "ids")
    named = with_smallest(work, rooted, "doc_id")
    return named.select("uid", "doc_id", "n_shingles", "component_id", "kept", "stays")


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id, with all its columns."""
    work = Work(docs.sparkSession, "minhash")
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("rest")
    rows = R.keyed(work, docs.select(others, "doc_id", "text"), "rest")
    found = near_duplicates(work, rows.select("uid", "doc_id", "text"), width, percent)
    gone = found.where("not stays").select("uid").checkpoint(eager=True)
    work.drop("members", "reps", "inside", "links", "rooted", "ids", "smallest")
    kept = rows.join(gone, "uid", "left_anti")
    return kept.select(*("text" if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "minhash")
    rows = R.keyed(work, table(spark, sf_dir, "documents"))
    return work.result(near_duplicates(work, rows, width=4, percent=80).drop("uid", "stays"))
