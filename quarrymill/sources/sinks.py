"""Outputs: chats as JSON lines, whole JSON documents, splits by language, logs, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def chat_lines(qa: DataFrame, *keep: str) -> DataFrame:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    messages = F.array(turn("user", "instruction"), turn("assistant", "response"))
    return qa.select(*keep, F.to_json(F.struct(messages.alias("messages"))).alias("value"))


def write_chats(qa: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Writes the rows and returns how many were written, counted as they are."""
    seen = Observation()
    chat_lines(qa).observe(seen, F.count("*").alias("n")).write.mode(mode).text(path)
    return seen.get["n"]


def write_by_language(qa: DataFrame, path: str) -> None:
    """Chats of all rows in path/combined, and of each language in path/by_language; languages without rows have none."""
    chat_lines(qa, "language").write.mode("overwrite").partitionBy("language").text(f"{path}/by_language")
    chat_lines(qa).write.mode("overwrite").text(f"{path}/combined")


def write_rows(rows: DataFrame, path: str, stats: DataFrame | None = None) -> None:
    """Rows as JSON lines in path/rows, statistics in path/stats; neither is gathered."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/rows")
    if stats is not None:
        stats.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/stats")


def write_document(path: str, order: str, metadata: DataFrame | None = None, pieces: bool = False, **sections: DataFrame) -> None:
    """One JSON document in one file: `metadata` (a row) and an array for each section, its rows in `order`.

    It is an export for readers of single files: one task writes it, line by line, and holds no section; large data are
    written by `write_rows`, or in pieces: files that are the document when they are put together by name, each written by
    a task of its own, and that `files.in_pieces` reads by many tasks.
    """
    spark = next(iter(sections.values())).sparkSession
    one = lambda k, text: spark.createDataFrame([(k, None, 0, text)], "part int, place bigint, side int, value string")
    lines = [one(0, "{")]
    if metadata is not None:
        lines.append(metadata.limit(1).select(
            F.lit(1).alias("part"), F.lit(None).cast("bigint").alias("place"), F.lit(0).alias("side"),
            F.concat(F.lit('"metadata": '), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), F.lit(",")).alias("value"),
        ))
    part = 2
    for i, (name, rows) in enumerate(sections.items()):
        lines.append(one(part, f'"{name}": ['))
        first = rows.agg(F.min(order).alias("first"))
        numbered = rows.crossJoin(F.broadcast(first))  # one row
        value = F.when(F.col(order) == F.col("first"), row_of(rows)).otherwise(F.concat(F.lit(","), row_of(rows)))
        lines.append(numbered.select(F.lit(part + 1).alias("part"), F.col(order).cast("bigint").alias("place"), F.lit(0).alias("side"), value.alias("value")))
        lines.append(one(part + 2, "]" if i == len(sections) - 1 else "],"))
        part += 3
    lines.append(one(part, "}"))
    every = lines[0]
    for x in lines[1:]:
        every = every.unionByName(x)
    dealt = every.repartitionByRange("part", "place") if pieces else every.repartitionByRange(1, "part", "place")
    ordered = dealt.sortWithinPartitions("part", "place")
    ordered.select("value").write.mode("overwrite").text(path)


def row_of(rows: DataFrame) -> F.Column:
    return F.to_json(F.struct(*(F.col(c) for c in rows.columns)), {"ignoreNullFields": "false"})


def append_log(events: DataFrame, path: str, *long_texts: str, most: int = 100) -> None:
    """Appends events; long texts are cut to their first characters."""
    events.withColumns({c: F.substring(c, 1, most) for c in long_texts}).write.mode("append").json(path)


def overlay(base: F.Column, changes: F.Column) -> F.Column:
    """Of two maps, the second where both have a key."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(changes, k)), changes)


def write_overlaid(rows: DataFrame, path: str, metadata: dict[str, str], order: str = "idx", pieces: bool = False, **changes: str) -> None:
    """A document of rows whose metadata are those of another, with changes and the number of rows."""
    as_map = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    counted = rows.agg(F.count("*").cast("string").alias("n"))
    whole = overlay(as_map(metadata), F.map_concat(as_map(changes), F.create_map(F.lit("total_pairs"), F.col("n"))))
    names = list(dict.fromkeys([*metadata, *changes, "total_pairs"]))
    meta = counted.select(whole.alias("m")).select(*(F.col("m")[n].alias(n) for n in names))
    write_document(path, order, meta, pieces, dataset=rows)


#: Files of a finished set, and what each is for.
PURPOSES = (("multilingual", "for_multilingual_model"), ("eng", "for_english_only"), ("fr", "for_french_only"))


def manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """path, lines, bytes and size in MB of the line files under those of the paths that are there."""
    from quarrymill.sources.files import exists

    there = [p for p in paths if exists(spark, p)]
    if not there:
        return spark.createDataFrame([], "path string, lines bigint, bytes bigint, size_mb double")
    files = spark.read.option("recursiveFileLookup", True).text(there).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    found = files.groupBy("path").agg(F.count("*").alias("lines"), F.first("bytes").alias("bytes"))
    return found.withColumn("size_mb", F.col("bytes") / (1024.0 * 1024.0))


def recommendations(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """purpose, path: which of the named files (multilingual, eng, fr) to use for what, of those that are there."""
    from quarrymill.sources.files import exists

    rows = [(purpose, files[n]) for n, purpose in PURPOSES if n in files and exists(spark, files[n])]
    return spark.createDataFrame(rows, "purpose string, path string")


def write_split(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").partitionBy("split").parquet(path)
