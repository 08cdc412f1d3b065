"""Removal of word sequences that occur more than once, by a log-structured index of fingerprints.

`FingerprintIndex` keeps two families of immutable runs in a named folder, which later sessions can open: anchors of
windows (see `repeats`), one row for each with the number of its blocks, and hashes of windows, one row for each with the
number of its windows; a row that stands for one block or window says where that is.  A run is bucketed by its key and
sorted within buckets.  A new batch becomes a run, which is merge-joined with the historical ones, bucket by bucket: they
are read in their order and neither shuffled nor sorted.  Anchors that are met again lead to their blocks (an earlier
block of which there was one only is looked up in its text); those blocks' windows become a run of hashes, which is
merge-joined with the historical ones in turn, and windows that are met again are hits, as are the earlier ones of which
there was one only.  When runs are many, they are compacted by a full outer merge join.

Windows are the same if their 64-bit hash and their anchor's are; equal blocks of windows are compared once, by as many
bits.  One key is one row in every join, however often it occurs.

Edge cases: a null text has no words; a text shorter than a window loses nothing; of repeated rows each loses all its
windows, the earlier ones too; rows with equal or null ids are rows of their own; very long texts are one row like
others; other columns do not matter; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import kernels as K
from quarrymill.llm import repeats as R
from quarrymill.llm.work import Work, table

WINDOW, RUN = 35, 8
BATCHES = 2
#: Keys and rows of the two families of runs; what follows `many` tells where a lone block or window is.
FAMILIES = {
    "anchors": (("fp",), "fp bigint, many bigint, block bigint, uid bigint, first bigint, n bigint"),
    "windows": (("hash", "fp"), "hash bigint, fp bigint, many bigint, uid bigint, place bigint"),
}
HITS = "uid bigint, first bigint, n bigint"


class FingerprintIndex:
    """Sorted immutable runs of the fingerprints of all batches so far, in a folder that sessions share.

    A document's uid is its own in all batches, and `corpus` is a table of (uid, text) in which earlier documents are
    found again.
    """

    def __init__(self, spark: SparkSession, root: str, window: int = WINDOW, run: int = RUN, most_runs: int = 4):
        self.spark, self.root, self.most_runs = spark, root.rstrip("/"), most_runs
        self.names: dict[str, str] = {}
        state = self._state()
        self.buckets = state.get("buckets") or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.window, self.run = state.get("window", window), state.get("run", run)
        self.runs: dict[str, list[str]] = {f: state.get(f, []) for f in FAMILIES}
        self.hit_runs: list[str] = state.get("hits", [])
        self.made = state.get("made", 0)
        # a bucket is one file: its order is the scan's
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        for family, runs in self.runs.items():
            for name in runs:
                self._register(family, name)

    def _states(self) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.root}/state-*")
        found = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
        return sorted((x.getPath().toString() for x in found or ()), key=lambda p: int(p.rpartition("-")[2]))

    def _state(self) -> dict:
        found = self._states()
        return json.loads(self.spark.read.text(found[-1]).first()[0]) if found else {}

    def _save(self, old: list[str]) -> None:
        """The new state counts once it is written whole; only then what it replaces is deleted."""
        before = self._states()
        state = {"buckets": self.buckets, "window": self.window, "run": self.run, "hits": self.hit_runs, "made": self.made, **self.runs}
        rows = self.spark.createDataFrame([(json.dumps(state),)], "value string")
        rows.coalesce(1).write.mode("overwrite").text(f"{self.root}/state-{self.made}")
        for path in [*before, *(f"{self.root}/{x}" for x in old)]:
            self._delete(path)

    def _delete(self, path: str) -> None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def _register(self, family: str, name: str) -> None:
        keys, schema = FAMILIES[family]
        self.names[name] = f"fingerprints_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {self.names[name]} ({schema}) USING parquet CLUSTERED BY ({', '.join(keys)}) SORTED BY ({', '.join(keys)}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.root}/{name}'"
        )

    def _name(self, kind: str) -> str:
        """Of a new folder: what a batch left that did not end is never in its way."""
        return f"{kind}-{self.made}-{uuid.uuid4().hex[:8]}"

    def _write(self, family: str, rows: DataFrame) -> str:
        """A run of rows that are dealt by the family's keys."""
        keys, schema = FAMILIES[family]
        name, self.made = self._name(family), self.made + 1
        self.names[name] = f"fingerprints_{uuid.uuid4().hex}"
        columns = [x.split()[0] for x in schema.split(", ")]
        writer = rows.select(*columns).write.bucketBy(self.buckets, *keys).sortBy(*keys).option("compression", "zstd")
        writer.option("path", f"{self.root}/{name}").saveAsTable(self.names[name])
        return name

    def _open(self, name: str) -> DataFrame:
        return self.spark.table(self.names[name])

    def _one_file_a_bucket(self, rows: DataFrame, family: str) -> DataFrame:
        """Rows that come from an aggregate by the keys are dealt as the buckets are if there are as many partitions."""
        same = int(self.spark.conf.get("spark.sql.shuffle.partitions")) == self.buckets
        return rows if same else rows.repartition(self.buckets, *FAMILIES[family][0])

    def met(self, family: str, new: str, earlier: list[str]) -> DataFrame:
        """The rows of a run with `before`, how many there were in earlier ones, and `lone`, where the only one was."""
        keys, schema = FAMILIES[family]
        out = self._open(new)
        columns, counts, lone = out.columns, [F.lit(0).cast("bigint")], []
        where = [x.split()[0] for x in schema.split(", ") if x.split()[0] not in (*keys, "many")]
        for i, name in enumerate(earlier):
            old = self._open(name).select(
                *(F.col(k).alias(f"k{i}_{k}") for k in keys), F.col("many").alias(f"many{i}"), F.struct(*where).alias(f"at{i}")
            )
            out = out.join(old.hint("merge"), [F.col(k) == F.col(f"k{i}_{k}") for k in keys], "left")
            counts.append(F.coalesce(F.col(f"many{i}"), F.lit(0)))
            lone.append(F.when(F.col(f"many{i}") == 1, F.col(f"at{i}")))
        before = reduce(lambda x, y: x + y, counts)
        kind = "struct<" + ", ".join(f"{c}: bigint" for c in where) + ">"
        only = F.when(before == 1, F.coalesce(*lone)) if lone else F.lit(None).cast(kind)
        return out.select(*columns, before.alias("before"), only.alias("lone"))

    def append(self, rows: DataFrame, corpus: DataFrame) -> None:
        """Adds a batch (uid, text), of which no document was added before."""
        work = Work(self.spark, "append")
        occurrences = work.table(R.occurrences(rows, R.word_blocks, self.window, self.run), "occurrences")
        at = F.min(F.struct("uid", "first", "n", "block")).alias("at")
        anchors = occurrences.groupBy("fp").agg(F.count("*").alias("many"), at).select("fp", "many", "at.*")
        run = self._write("anchors", self._one_file_a_bucket(anchors, "anchors"))
        again = work.table(self.met("anchors", run, self.runs["anchors"]).where("many + before > 1").select("fp", "lone"), "again")
        self.runs["anchors"].append(run)

        blocks = occurrences.join(again.select("fp"), "fp", "left_semi").select("fp", "block", "uid", "first", "n")
        woken = again.where("lone is not null").select("fp", "lone.block", "lone.uid", "lone.first", "lone.n")
        blocks = work.table(blocks.unionByName(woken), "blocks")
        one = F.min(F.struct("uid", "first", "n")).alias("at")
        groups = work.table(blocks.groupBy("fp", "block").agg(F.count("*").alias("many"), one), "groups")
        copies = blocks.join(groups.where("many > 1").select("fp", "block"), ["fp", "block"], "left_semi").select("uid", "first", "n")

        listed = groups.select("fp", "at.*", (F.col("many") > 1).alias("copy"))
        made = R.bodies(corpus, listed, _windows(self.window), "fp bigint, hash bigint, uid bigint, place bigint, copy boolean")
        windows = work.table(made, "windows")
        many = F.sum(F.when(F.col("copy"), 2).otherwise(1)).alias("many")
        hashes = windows.groupBy("hash", "fp").agg(many, F.min(F.struct("uid", "place")).alias("at")).select("hash", "fp", "many", "at.*")
        run = self._write("windows", self._one_file_a_bucket(hashes, "windows"))
        twice = work.table(self.met("windows", run, self.runs["windows"]).where("many + before > 1").select("hash", "fp", "lone"), "twice")
        self.runs["windows"].append(run)

        single = F.lit(1).cast("bigint").alias("n")
        mine = windows.where("not copy").join(twice.select("hash", "fp"), ["hash", "fp"], "left_semi")
        earlier = twice.where("lone is not null").select("lone.uid", F.col("lone.place").alias("first"), single)
        hits = copies.unionByName(mine.select("uid", F.col("place").alias("first"), single)).unionByName(earlier)
        name, self.made = self._name("hits"), self.made + 1
        hits.write.option("compression", "zstd").parquet(f"{self.root}/{name}")
        self.hit_runs.append(name)
        work.close()
        self._save(self.compact() if len(self.runs["anchors"]) > self.most_runs else [])

    def compact(self) -> list[str]:
        """Merges the runs of each family into one; returns those that it replaces."""
        replaced = []
        for family, runs in self.runs.items():
            keys, schema = FAMILIES[family]
            columns = [x.split()[0] for x in schema.split(", ")]
            merged = self._open(runs[0])
            for name in runs[1:]:
                other = self._open(name).select(*(F.col(c).alias(f"other_{c}") for c in columns))
                joined = merged.join(other.hint("merge"), [F.col(k) == F.col(f"other_{k}") for k in keys], "full")
                merged = joined.select(*(
                    (F.coalesce("many", F.lit(0)) + F.coalesce("other_many", F.lit(0))).alias("many") if c == "many"
                    else F.coalesce(c, f"other_{c}").alias(c) for c in columns
                ))
            if len(runs) > 1:
                self.runs[family] = [self._write(family, merged)]
                for name in runs:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop(name)}")
                replaced += runs
        return replaced

    def hits(self) -> DataFrame:
        """uid, first, n: ranges of repeated windows of all documents so far."""
        if not self.hit_runs:
            return self.spark.createDataFrame([], HITS)
        return self.spark.read.schema(HITS).parquet(*(f"{self.root}/{x}" for x in self.hit_runs))

    def close(self) -> None:
        """Forgets the tables' names; the files stay for the next session."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = {}


def _windows(window: int):
    """The listed blocks' windows as hashes: fp, hash, uid, place, copy."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, owner, fp, first, n, copy = R.block_columns(batch)
            by_owner = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            for part in K.slices(batch.column("text")):
                x, y = by_owner[part.row], by_owner[part.row + part.n]
                starts, ends, lo, _ = part.words()
                hashes = K.word_windows(part.word_hashes(starts, ends), window).view(np.int64)
                counts = n[x:y]
                each = np.repeat(np.arange(x, y), counts)
                place = R.ranges(first[x:y], counts)
                found = hashes[lo[owner[each] - part.row] + place]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (fp[each], found, uid[each], place, copy[each])], ["fp", "hash", "uid", "place", "copy"]
                )

    return make


def repeated(work: Work, rows: DataFrame, window: int = WINDOW, run: int = RUN, batches: int = BATCHES) -> DataFrame:
    """uid and `hits` of the documents that have repeated windows; the documents come in batches by their uid."""
    index = FingerprintIndex(work.spark, f"{work.root}/index", window, run, most_runs=1)
    for i in range(batches):
        index.append(rows.where(F.pmod(F.xxhash64("uid"), F.lit(batches)) == i), rows)
    found = index.hits()
    index.close()
    return found.groupBy("uid").agg(F.collect_list(F.struct("first", "n")).alias("hits"))


def digests(work: Work, docs: DataFrame, window: int = WINDOW, run: int = RUN, batches: int = BATCHES) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    rows = R.keyed(work, docs)
    hits = repeated(work, rows, window, run, batches)

    def make(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            out: list[list] = [[], [], []]
            for text, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("hits").to_pylist()):
                words = (text or b"").split()
                spans = R.merged(found, window)
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                digest = hashlib.sha256(b" ".join(kept)).hexdigest()
                for column, x in zip(out, (len(words), sum(b - a for a, b in spans), digest)):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in out[:2]), pa.array(out[2], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return R.with_hits(rows, hits).mapInArrow(
        make, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    )


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "substring-dedup")
    return work.result(digests(work, table(spark, sf_dir, "documents")))
