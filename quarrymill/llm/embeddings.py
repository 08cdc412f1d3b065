"""Near-duplicate vectors by an epsilon grid order join.

Cosine of unit vectors is 1 less half their squared distance, so that vectors at a cosine of `least` or more lie within
epsilon = sqrt(2 - 2 * least).  Unit vectors are turned to their principal directions and sorted by grid cells of that
width on the leading ones (any rotation keeps distances, so that the directions may come from a bounded sample).  The
sequence is cut into blocks; pairs of blocks whose bounds are farther apart than epsilon are skipped, the others are
joined by recursion on halves of their intervals, with the same test, down to small pieces that are multiplied out.
Blocks are large, so that a vector is sent to few pairs of blocks and the recursion, which sends nothing, does most of
the skipping; vectors whose components are single-precision numbers travel as such.

Equal vectors are one row with a count.  A pair of blocks gives the number of links of each vector and links that span
its components, never all pairs.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and those without a label, link
with nothing; vectors of different lengths neither; ties at the bound are links; repeated rows link with each other;
rows with equal or null ids are rows of their own; other columns do not matter; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm.groups import local_roots, with_smallest
from quarrymill.llm.work import Work, components, table

LEAST = 0.98
LEADING = 6
BLOCK_ROWS = 2048
LEAF_ROWS = 64
SAMPLE = 4096


def prepared(rows: DataFrame) -> DataFrame:
    """uid, label, dim and the vector in bytes, of floats if they hold it and of doubles if not; rows that link with
    nothing are left out."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding").cast(pa.list_(pa.float64()))
            usable, dims, out = [], [], []
            for i, v in enumerate(lists):
                if v.is_valid and len(v.values):
                    x = v.values.to_numpy(zero_copy_only=False)  # nulls become NaN
                    if np.isfinite(x).all() and x.any():
                        usable.append(i)
                        dims.append(len(x))
                        with np.errstate(over="ignore"):
                            short = x.astype(np.float32)
                        out.append(((short if (short == x).all() else x) + 0.0).tobytes())
            kept = batch.select(["uid", "label"]).take(pa.array(usable, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["uid", "label", "dim", "v"])

    return rows.where("label is not null and embedding is not null").select("uid", "label", "embedding").mapInArrow(
        make, "uid bigint, label string, dim int, v binary"
    )


def numbers(data: bytes, dim: int) -> np.ndarray:
    """The vector of so many components."""
    return np.frombuffer(data, np.float64 if len(data) == 8 * dim else np.float32).astype(np.float64)


def directions(distinct: DataFrame, sample: int) -> dict[int, np.ndarray]:
    """Principal directions by vector length, from at most `sample` vectors of each length, chosen by a hash."""
    found: dict[int, np.ndarray] = {}
    for (dim,) in distinct.select("dim").distinct().collect():
        rows = distinct.where(F.col("dim") == dim).select("v").orderBy(F.xxhash64("uid")).limit(sample).collect()
        x = np.stack([numbers(r.v, dim) for r in rows])
        x = x / np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        found[dim] = np.linalg.eigh(np.cov(x.T, bias=True).reshape(dim, dim))[1][:, ::-1][:, :LEADING].copy()
    return found


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


CELLS = [f"c{i}" for i in range(LEADING)]
BLOCK = "bid bigint, label string, dim int, lo array<double>, hi array<double>, uids binary, sizes binary, v binary"


def blocks(distinct: DataFrame, turn: dict[int, np.ndarray], epsilon: float, size: int) -> DataFrame:
    """Vectors in grid order, `size` to a block; bounds are of the leading coordinates."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            out = np.zeros((batch.num_rows, LEADING), np.int32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                v = np.stack([numbers(batch.column("v")[i].as_py(), int(dim)) for i in at.tolist()])
                y = np.floor(unit(v) @ turn[dim] / epsilon).astype(np.int32)
                out[at, : y.shape[1]] = y
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in out.T)], [*batch.schema.names, *CELLS])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bid, held, key = TaskContext.get().partitionId() << 32, [], None

        def block():
            v = np.stack([numbers(r["v"], key[1]) for r in held])
            y = unit(v) @ turn[key[1]]
            short = all(len(r["v"]) == 4 * key[1] for r in held)
            return {
                "bid": bid, "label": key[0], "dim": key[1], "lo": y.min(0).tolist(), "hi": y.max(0).tolist(),
                "uids": np.array([r["uid"] for r in held], np.int64).tobytes(),
                "sizes": np.array([r["size"] for r in held], np.int64).tobytes(), "v": (v.astype(np.float32) if short else v).tobytes(),
            }

        for batch in batches:
            for r in batch.select(["uid", "label", "dim", "size", "v"]).to_pylist():
                if held and (len(held) == size or (r["label"], r["dim"]) != key):
                    yield pa.RecordBatch.from_pylist([block()], schema)
                    held, bid = [], bid + 1
                key = (r["label"], r["dim"])
                held.append(r)
        if held:
            yield pa.RecordBatch.from_pylist([block()], schema)

    kinds = (pa.int64(), pa.string(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), *[pa.binary()] * 3)
    schema = pa.schema(list(zip([x.split()[0] for x in BLOCK.split(", ")], kinds)))
    order = ["label", "dim", *CELLS, "uid"]
    placed = distinct.select("uid", "label", "dim", "size", "v").mapInArrow(
        cells, "uid bigint, label string, dim int, size bigint, v binary, " + ", ".join(f"{c} int" for c in CELLS)
    )
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, BLOCK)


def block_pairs(made: DataFrame, epsilon: float) -> DataFrame:
    """(x, y), x <= y: pairs of blocks of one label within epsilon of each other, by stripes of the first coordinate."""
    bounds = made.select("bid", "label", "dim", "lo", "hi")

    def stripes(column: str, more: float) -> F.Column:
        low = F.floor((F.get(F.col("lo"), 0) - more) / epsilon)
        return F.explode(F.sequence(low, F.floor((F.get(F.col("hi"), 0) + more) / epsilon))).alias(column)

    def named(prefix: str, more: float) -> DataFrame:
        columns = [F.col(c).alias(f"{prefix}_{c}") for c in ("bid", "lo", "hi")]
        return bounds.select(*columns, "label", "dim", stripes("stripe", more))

    apart = F.aggregate(
        F.transform("x_lo", lambda a, i: F.greatest(
            F.lit(0.0), F.get("y_lo", i) - F.get("x_hi", i), a - F.get("y_hi", i)
        )), F.lit(0.0), lambda s, d: s + d * d,
    )
    return (
        named("x", 0.0).join(named("y", epsilon * 1.001), ["label", "dim", "stripe"])
        .where("x_bid <= y_bid").where(apart <= (epsilon * 1.001) ** 2)
        .select(F.col("x_bid").alias("x"), F.col("y_bid").alias("y")).distinct()
    )


def links_within(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, least: float, reach: float) -> np.ndarray:
    """Matrix of links between two intervals of the grid order; px, py are their leading coordinates."""
    out = np.zeros((len(x), len(y)), bool)

    def join(a: int, b: int, c: int, d: int) -> None:
        gap = np.maximum(0, np.maximum(py[c:d].min(0) - px[a:b].max(0), px[a:b].min(0) - py[c:d].max(0)))
        if gap @ gap > reach:
            return
        if b - a <= LEAF_ROWS and d - c <= LEAF_ROWS:
            out[a:b, c:d] = x[a:b] @ y[c:d].T >= least
        elif b - a >= d - c:
            join(a, (a + b) // 2, c, d)
            join((a + b) // 2, b, c, d)
        else:
            join(a, b, c, (c + d) // 2)
            join(a, b, (c + d) // 2, d)

    join(0, len(x), 0, len(y))
    return out


def joined(pairs: DataFrame, made: DataFrame, turn: dict[int, np.ndarray], least: float, epsilon: float) -> DataFrame:
    """Per pair of blocks: uid, the number of other vectors it links with there, and the first vector of its component."""
    data = made.select("bid", "dim", "uids", "sizes", "v")
    left = data.select(F.col("bid").alias("x"), "dim", *(F.col(c).alias(f"x_{c}") for c in ("uids", "sizes", "v")))
    right = data.select(F.col("bid").alias("y"), *(F.col(c).alias(f"y_{c}") for c in ("uids", "sizes", "v")))
    rows = pairs.join(left, "x").join(right, F.when(pairs.x != pairs.y, pairs.y) == right.y, "left").select("x", pairs.y, "dim", "x_uids", "x_sizes", "x_v", "y_uids", "y_sizes", "y_v")
    reach = (epsilon * 1.001) ** 2

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                dim, same = r["dim"], r["x"] == r["y"]
                if same:
                    r |= {f"y_{c}": r[f"x_{c}"] for c in ("uids", "sizes", "v")}
                raw = [numbers(r[f"{s}_v"], dim * (len(r[f"{s}_uids"]) // 8)).reshape(-1, dim) for s in "xy"]
                x, y = map(unit, raw)
                near = links_within(x, y, x @ turn[dim], y @ turn[dim], least - 1e-9, reach)
                # the bound itself is tested on the vectors as given (but for a power of two), in double precision
                raw = [np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1]) for v in raw]
                a, b = np.nonzero(near)
                for k in range(0, len(a), 1 << 16):
                    p, q = raw[0][a[k : k + (1 << 16)]], raw[1][b[k : k + (1 << 16)]]
                    cos = (p * q).sum(1) / (np.sqrt((p * p).sum(1)) * np.sqrt((q * q).sum(1)))
                    off = ~(cos >= least)
                    near[a[k : k + (1 << 16)][off], b[k : k + (1 << 16)][off]] = False
                ids = [np.frombuffer(r[c], np.int64) for c in ("x_uids", "y_uids")]
                sizes = [np.frombuffer(r[c], np.int64) for c in ("x_sizes", "y_sizes")]
                if same:
                    np.fill_diagonal(near, False)
                    uid, links, square = ids[0], near @ sizes[0], near
                else:
                    uid, links = np.concatenate(ids), np.concatenate([near @ sizes[1], near.T @ sizes[0]])
                    n = len(ids[0])
                    square = np.zeros((len(uid), len(uid)), bool)
                    square[:n, n:], square[n:, :n] = near, near.T
                on = np.flatnonzero(links)
                root = local_roots(square[np.ix_(on, on)]) if len(on) else on
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[on]), pa.array(links[on]), pa.array(uid[on][root])], ["uid", "links", "root"]
                )

    return rows.mapInArrow(make, "uid bigint, links bigint, root bigint")


def near_duplicates(
    work: Work, vectors: DataFrame, least: float = LEAST, id_column: str = "vec_id", size: int = BLOCK_ROWS,
    sample: int = SAMPLE,
) -> DataFrame:
    """Per row of (id, embedding, label): id, n_links, component_id, kept, and stays, one row of each component."""
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias(id_column), F.col("label").cast("string").alias("label"), "embedding"
    )
    counts = rows.agg(F.count("*"), F.count_distinct(id_column)).first()
    if counts[0] == counts[1]:
        rows = rows.withColumn("uid", F.col(id_column))
    else:
        rows = work.table(rows.withColumn("uid", F.monotonically_increasing_id()), "keyed")
    ready = work.table(prepared(rows), "ready")
    keys = ["label", "dim", "name"]
    hashed = ready.select("uid", "label", "dim", F.md5("v").alias("name"))
    equal = hashed.groupBy(*keys).agg(F.min("uid").alias("rep"), F.count("*").alias("size"))
    members = work.table(hashed.join(equal, keys).select("uid", "rep", "size"), "members")
    distinct = work.table(ready.join(members.where("uid = rep").select("uid", "size"), "uid"), "distinct")
    turn = directions(distinct, sample)
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * least))) or 1e-6
    made = work.table(blocks(distinct, turn, epsilon, size), "blocks")
    found = work.table(joined(block_pairs(made, epsilon), made, turn, least, epsilon), "found")
    links = found.groupBy("uid").agg(F.sum("links").alias("links")).withColumnRenamed("uid", "of")
    linked = components(work, found.select(F.col("uid").alias("a"), F.col("root").alias("b")), "linked")
    named = (
        members.join(links, members.rep == links.of, "left").join(linked, F.col("rep") == linked.node, "left")
        .select(F.col("uid").alias("member"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("root", "rep").alias("root"))
    )
    every = rows.select("uid", id_column).join(named, F.col("uid") == F.col("member"), "left")
    every = every.select("uid", id_column, F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "uid").alias("root"))
    named = with_smallest(work, work.table(every, "every"), id_column)
    return named.select(id_column, "n_links", "component_id", "kept", "stays")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "embeddings")
    return work.result(near_duplicates(work, table(spark, sf_dir, "embeddings")).drop("stays"))
