"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Terms are all lower-case words of the examples and the words' beginnings of STEM letters (so that an inflected form meets
its kin), whatever their number, frequency or labels; a word is a run of letters, and of all characters beyond ASCII, and
terms are known by 64-bit hashes.  A term's weight is its TF-IDF times how well it tells toxic
examples from others (the log likelihood ratio of its counts, plus FLOOR); none is left out.  Document frequencies are
counted over all documents.  Examples with equal vectors are one entry, with one vote that is their share of label 1.

The index keeps, for each term, the entries that hold it in order, cut into blocks with their largest weight.  Blocks of
the DENSE terms with most entries hold a weight for each entry of the block, so that a block is scored by one product for
many texts; all other terms list the entries that hold them.  Texts are searched for many at a time: the blocks of the
largest bounds give each a first k-th best cosine, and of the other blocks those whose bound is below it are skipped, as
they hold none of the k nearest.  What comes near the k-th best is summed up again in double precision, so that the k
nearest are exact.  Votes are weighted by distance and calibrated on the examples, each without the vote of its own
entry; the nearest entries are the evidence.

At most EXAMPLES labelled documents with EXAMPLE_BYTES of text in all are used, chosen by a hash of their ids.

Edge cases: a null or empty text, like any without a term of the examples, gets the rate of examples without one; so
does every text if there are no toxic examples or no others.  Ties of cosine go to the earlier entry.  A label that is
null is none; an id with several labels is toxic if one says so.  Rows with equal or null ids are scored each by itself;
very long texts are one row like others; other columns do not matter, `without_toxic` returns them as they are; an empty
table gives none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import kernels as K
from quarrymill.llm.labelled import held_out, isotonic, training_sample
from quarrymill.llm.repeats import ranges
from quarrymill.llm.work import Work, release_memory, table, tidy

EXAMPLES = 4_000
EXAMPLE_BYTES = 16 << 20
NEAREST = 25
#: Letters of the beginnings of words that are terms too.
STEM = 6
#: Added to every term's log likelihood ratio, so that none weighs nothing.
FLOOR = 0.01
BLOCK = 64
#: Terms whose blocks hold all entries' weights; how the index is laid out, no matter for results.
DENSE = 1536
#: Blocks of the largest bounds that are read before the others are held against the k-th best.
FIRST_BLOCKS = 4
#: Texts that are searched for at a time.
TOGETHER = 256
#: Cosine from which an entry is the example itself, which does not vote on itself in the calibration.
KIN = 1 - 1e-9
CALIBRATION_TASKS = 32
_OF_STEM = np.uint64(0x2545F4914F6CDD1D)


def _hashed(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """By slices of the texts: the first text and their number, and of each term the text within the slice and the hash."""
    for part in K.slices(pc.utf8_lower(texts)):
        starts, ends, lo, hi = part.words(K.NO_LETTER)
        sums = K.prefix(K._BYTES[part.data], K._BASE)
        letter = (part.data & 0xC0) != 0x80
        after = (np.cumsum(letter) - 1)[starts] + STEM
        begins = np.append(np.flatnonzero(letter), len(part.data))
        stem = begins[np.minimum(after, len(begins) - 1)]
        long = np.flatnonzero(stem < ends)
        owner = np.repeat(np.arange(part.n), hi - lo)
        words, stems = K.spans(sums, K._BASE, starts, ends), K.spans(sums, K._BASE, starts[long], stem[long])
        yield part.row, part.n, np.concatenate([owner, owner[long]]), np.concatenate([words, K.mix(stems ^ _OF_STEM)])


def vocabulary(chosen: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All terms of the examples (as hashes) and the log likelihood ratios of their labels, the largest first; none
    without two labels."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y").to_numpy() > 0
            for row, _, owner, found in _hashed(batch.column("text")):
                terms, number = np.unique(found, return_inverse=True)
                pair = np.unique(number * (1 << 32) + owner)
                number, toxic = pair >> 32, y[row + (pair & (2**32 - 1))]
                counts = [np.bincount(number[on], minlength=len(terms)) for on in (~toxic, toxic)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (terms.view(np.int64), *counts)], ["term", "n0", "n1"])
        release_memory()

    totals = chosen.agg(F.sum(F.when(F.col("y") > 0, 1).otherwise(0)), F.count("*")).first()
    if not totals[0] or totals[0] == totals[1]:
        return np.zeros(0, np.uint64), np.zeros(0)
    counted = chosen.select("text", "y").mapInArrow(make, "term bigint, n0 bigint, n1 bigint")
    found = counted.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    gain = gains(*(found.column(c).to_numpy().astype(float) for c in ("n0", "n1")), float(totals[1] - totals[0]), float(totals[0]))
    term = found.column("term").to_numpy()
    order = np.lexsort((term, -gain))
    return term[order].view(np.uint64), gain[order]


def gains(with0: np.ndarray, with1: np.ndarray, n0: float, n1: float) -> np.ndarray:
    """Log likelihood ratios of terms that so many of n0 and n1 examples have."""
    rate = (with0 + with1) / (n0 + n1)
    gain = sum(x * np.log(np.where(x > 0, x, 1) / n / np.where(x > 0, rate, 1 / n)) for x, n in ((with0, n0), (with1, n1)))
    return np.maximum(gain, 0.0)


def counted(numbers: K.Numbering, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text its terms that examples have, in order, and their counts."""
    for _, n, owner, found in _hashed(texts):
        term = numbers.find(found)
        on = term >= 0
        pair, count = np.unique(owner[on] * (1 << 32) + term[on], return_counts=True)
        cuts = np.searchsorted(pair, np.arange(1, n) * (1 << 32))
        yield from zip(np.split((pair & (2**32 - 1)).astype(np.int32), cuts), np.split(count.astype(np.int32), cuts))


def term_counts(rows: DataFrame, terms: Broadcast) -> DataFrame:
    """doc_id and y, and the text's terms and their counts, in the terms' order."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = K.Numbering(terms.value)
        for batch in batches:
            found = list(counted(numbers, batch.column("text")))
            columns = [pa.array([f[i] for f in found], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), *columns], ["doc_id", "y", "terms", "counts"])
        del numbers
        release_memory()

    return rows.select("doc_id", "y", "text").mapInArrow(make, "doc_id bigint, y int, terms array<int>, counts array<int>")


def document_frequencies(rows: DataFrame, terms: Broadcast) -> np.ndarray:
    """How many texts have each term; a task sends one row for each term that it met."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = K.Numbering(terms.value)
        many = np.zeros(len(numbers.keys), np.int64)
        for batch in batches:
            for _, _, owner, found in _hashed(batch.column("text")):
                term = numbers.find(found)
                on = term >= 0
                many += np.bincount(np.unique(owner[on] * (1 << 32) + term[on]) & (2**32 - 1), minlength=len(many))
        met = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(many[met])], ["t", "n"])
        del numbers, many
        release_memory()

    found = rows.select("text").mapInArrow(make, "t int, n bigint").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(terms.value))
    out[found.column("t").to_numpy()] = found.column("n").to_numpy()
    return out


def vector(scale: np.ndarray, terms, counts) -> np.ndarray:
    """The unit vector of term weights."""
    w = (1 + np.log(np.asarray(counts, float))) * scale[np.asarray(terms, np.int64)]
    return w / np.sqrt(w @ w)


def _side_by_side(table: np.ndarray) -> np.ndarray:
    """An order of the rows in which those that are alike share blocks: halved along their main direction, and so on."""
    rows = np.arange(len(table))
    if len(table) <= BLOCK or not table.shape[1]:
        return rows
    x = table - table.mean(0)
    v = np.random.default_rng(0).standard_normal(x.shape[1]).astype(np.float32)
    for _ in range(6):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v) + np.float32(1e-30)
    rows = np.argsort(x @ v, kind="stable")
    half = -(-len(rows) // BLOCK) // 2 * BLOCK
    return np.concatenate([part[_side_by_side(table[part])] for part in (rows[:half], rows[half:])])


@dataclass
class Index:
    """Entries (distinct vectors of examples) by term, in blocks with their largest weights.

    Weights are single-precision numbers; cosines are sums of their products in double precision.
    """

    scale: np.ndarray  # of each term's weight
    votes: np.ndarray  # share of label 1, by entry
    evidence: np.ndarray  # a document of each entry
    column: np.ndarray  # of each term among the dense ones, -1 for others
    dense: np.ndarray  # weights of dense terms, by block, entry and column
    dense_most: np.ndarray  # the largest, by block and column
    by_term: np.ndarray  # of other terms the first place in `entry` and `weight`, which are by term, then in order
    entry: np.ndarray
    weight: np.ndarray
    empty: float  # the rate of examples without a term
    base: float

    @classmethod
    def build(cls, rows: Iterable[tuple], scale: np.ndarray, dense: int = DENSE) -> Index:
        """Of (doc_id, y, terms, counts)."""
        n = positive = n_bare = positive_bare = 0
        groups: dict[tuple[bytes, bytes], list[int]] = {}  # big-endian numbers have the order of their bytes
        for doc, y, terms, counts in rows:
            n, positive = n + 1, positive + y
            if not len(terms):
                n_bare, positive_bare = n_bare + 1, positive_bare + y
                continue
            e = groups.setdefault(tuple(np.asarray(x, ">i4").tobytes() for x in (terms, counts)), [0, 0, doc])
            e[:] = e[0] + y, e[1] + 1, min(e[2], doc)
        base = (positive + 0.5) / (n + 1)
        keys = sorted(groups)
        entries = [groups[k] for k in keys]
        of = [[np.frombuffer(x, ">i4").astype(np.int32) for x in key] for key in keys]
        none = [np.zeros(0, np.int32)]
        term = np.concatenate([t for t, _ in of] or none)
        weight = np.concatenate([vector(scale, t, c).astype(np.float32) for t, c in of] or [np.zeros(0, np.float32)])
        sizes = [len(t) for t, _ in of]
        held = np.bincount(term, minlength=len(scale))
        common = np.argsort(-held, kind="stable")[:dense]
        common = common[held[common] > 0]
        column = np.full(len(scale), -1, np.int32)
        column[common] = np.arange(len(common))
        blocks = -(-len(of) // BLOCK)
        on, owner = column[term] >= 0, np.repeat(np.arange(len(of)), sizes)
        table = np.zeros((blocks * BLOCK, len(common)), np.float32)
        table[owner[on], column[term[on]]] = weight[on]
        place = _side_by_side(table[: len(of)])
        table[: len(of)], entries = table[place], [entries[i] for i in place.tolist()]
        table = table.reshape(blocks, BLOCK, len(common))
        entry = np.argsort(place, kind="stable").astype(np.int32)[owner]
        term, entry, weight = term[~on], entry[~on], weight[~on]
        order = np.lexsort((entry, term))
        term, entry, weight = term[order], entry[order], weight[order]
        numbers = np.arange(len(scale) + 1)
        return cls(
            scale, np.array([e[0] / e[1] for e in entries]), np.array([e[2] for e in entries], np.int64), column, table,
            table.max(1) if blocks else np.zeros((0, len(common)), np.float32), np.searchsorted(term, numbers).astype(np.int32), entry, weight,
            (positive_bare + base) / (n_bare + 1), base,
        )

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text (terms, counts; at least one term) the k entries of the largest cosines above zero: the text, the
        entry and the cosine, the nearest first and earlier entries first among equal ones."""
        m, blocks = len(texts), len(self.dense)
        terms = np.concatenate([t for t, _ in texts]).astype(np.int64)
        owner = np.repeat(np.arange(m), [len(t) for t, _ in texts])
        q = np.concatenate([vector(self.scale, t, c) for t, c in texts])
        at = self.column[terms]
        wide = np.zeros((m, self.dense.shape[2]))
        wide[owner[at >= 0], at[at >= 0]] = q[at >= 0]
        narrow = wide.astype(np.float32)
        owner, terms, q = owner[at < 0], terms[at < 0], q[at < 0]

        sizes = self.by_term[terms + 1] - self.by_term[terms]
        place = ranges(self.by_term[terms], sizes)
        sums = np.bincount(
            np.repeat(owner * (blocks * BLOCK), sizes) + self.entry[place], np.repeat(q, sizes) * self.weight[place], m * blocks * BLOCK
        )
        rest = sums.reshape(m, blocks, BLOCK)  # what listed terms add to each cosine, so that their share of a bound is exact
        bound = narrow @ self.dense_most.T + rest.max(2) + 1e-5
        score = np.zeros((blocks, m, BLOCK))
        left = np.ones((m, blocks), bool)

        def read(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(0)).tolist():
                of = np.flatnonzero(wanted[:, b])
                score[b, of] = narrow[of] @ self.dense[b].T + rest[of, b]
            left[wanted] = False

        first = min(max(FIRST_BLOCKS, -(-k // BLOCK)), blocks)
        best = np.argpartition(-bound, first - 1, axis=1)[:, :first]
        wanted = np.zeros((m, blocks), bool)
        wanted[np.arange(m)[:, None], best] = True
        read(wanted)
        have = score[best, np.arange(m)[:, None]].reshape(m, -1)
        least = np.partition(have, have.shape[1] - k, axis=1)[:, -k] if have.shape[1] >= k else np.zeros(m)
        read(left & (bound >= least[:, None]))
        block, text, place = np.nonzero(score >= np.maximum(least, 2e-5)[:, None] - 1e-5)
        if len(text):  # the k-th best of all that was read
            cosine = score[block, text, place]
            place += block * BLOCK
            order = np.lexsort((-cosine, text))
            starts = np.searchsorted(text[order], np.arange(m + 1))
            kth = np.minimum(starts[:-1] + k, starts[1:]) - 1
            bar = np.where(kth >= starts[:-1], cosine[order[np.maximum(kth, 0)]], 0)
            on = cosine >= bar[text] - 1e-5
            text, place = text[on], place[on]
        exact = np.empty(len(text))
        flat = self.dense.reshape(blocks * BLOCK, self.dense.shape[2])
        for i in range(0, len(text), 1024):
            a, b = text[i : i + 1024], place[i : i + 1024]
            exact[i : i + 1024] = np.einsum("ij,ij->i", wide[a], flat[b], dtype=np.float64)
        exact += rest.reshape(m, -1)[text, place]
        order = np.lexsort((place, -np.round(exact, 12), text))
        text, place, exact = text[order], place[order], exact[order]
        rank = np.arange(len(text)) - np.searchsorted(text, text)
        on = (rank < k) & (exact > 0)
        return text[on], place[on], exact[on]

    def votes_on(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, kin: float | None = None) -> tuple[np.ndarray, list[list[int]]]:
        """Each text's share of votes for label 1, weighted by distance, and its nearest entries' documents; texts
        without a term have the share NaN.  Entries nearer than `kin` do not vote."""
        share, evidence = np.full(len(texts), np.nan), [[] for _ in texts]
        ours = [i for i, (t, _) in enumerate(texts) if len(t)]
        for i in range(0, len(ours) if len(self.votes) else 0, TOGETHER):
            part = ours[i : i + TOGETHER]
            text, entry, cosine = self.nearest([texts[j] for j in part], k)
            weight = 1 / (1.05 - np.minimum(cosine, 1.0))
            if kin is not None:
                weight[cosine >= kin] = 0
            total = np.bincount(text, weight, len(part))
            share[part] = (np.bincount(text, weight * self.votes[entry], len(part)) + self.base) / (total + 1)
            cuts = np.searchsorted(text, np.arange(len(part) + 1)).tolist()
            named = self.evidence[entry].tolist()
            for j, a, b in zip(part, cuts, cuts[1:]):
                evidence[j] = named[a : min(b, a + 3)]
        return share, evidence


def fit(docs: DataFrame, chosen: DataFrame, terms: Broadcast, gain: np.ndarray, k: int) -> tuple[Broadcast, tuple | None]:
    """The index of the examples, sent to workers once, and its calibration; document frequencies are of all documents."""
    scale = (np.log((docs.count() + 1) / (document_frequencies(docs, terms) + 1)) + 1) * (gain + FLOOR) if len(gain) else gain
    examples = term_counts(chosen, terms)
    rows = examples.toArrow()
    index = Index.build(
        (tuple(x) for b in rows.to_batches() for x in zip(*(c.to_pylist() for c in b.columns[:2]), *(_arrays(c) for c in b.columns[2:]))), scale
    )
    del rows
    some = len(index.votes) > 0
    shared = docs.sparkSession.sparkContext.broadcast(index)
    del index

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share, _ = shared.value.votes_on(list(zip(*map(_arrays, batch.columns[2:]))), k, KIN)
            on = np.flatnonzero(~np.isnan(share))
            yield pa.RecordBatch.from_arrays([pa.array(share[on]), batch.column("y").take(pa.array(on))], ["share", "y"])

    if not some:
        return shared, None
    votes = examples.repartition(CALIBRATION_TASKS).mapInArrow(tidy(make), "share double, y int").toArrow()
    y = votes.column("y").to_numpy().astype(float)
    return shared, isotonic(votes.column("share").to_numpy(), y, np.ones(len(y)))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    """The lists of a column."""
    bounds = column.offsets.to_numpy()
    return np.split(column.values.to_numpy()[bounds[0] : bounds[-1]], bounds[1:-1] - bounds[0]) if len(column) else []


class _Scores:
    """Scores and evidence of texts."""

    def __init__(self, index: Index, steps: tuple | None, terms: np.ndarray, k: int):
        self.index, self.steps, self.k, self.numbers = index, steps, k, K.Numbering(terms)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, list[list[int]]]:
        share, evidence = self.index.votes_on(list(counted(self.numbers, texts)), self.k)
        known = ~np.isnan(share)
        score = np.full(len(share), self.index.empty)
        if known.any():
            score[known] = np.interp(share[known], *self.steps)
        return score, evidence


def _fitted(work: Work, docs: DataFrame, labels: DataFrame, label: str, out: F.Column, bound: int, size: int, k: int):
    """Index, calibration and terms; the examples' table is deleted by the caller's `work`."""
    chosen = training_sample(docs, labels, label, out, bound, size).select("doc_id", "y", "text")
    chosen = work.table(chosen, "examples")
    found, gain = vocabulary(chosen)
    terms = docs.sparkSession.sparkContext.broadcast(found)
    return (*fit(docs, chosen, terms, gain, k), terms)


def scored(
    work: Work, docs: DataFrame, labels: DataFrame, label: str = "toxic", out: F.Column | None = None,
    bound: int = EXAMPLES, k: int = NEAREST, size: int = EXAMPLE_BYTES,
) -> DataFrame:
    """doc_id, score and evidence (documents of the nearest entries) for each row of docs."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    index, steps, terms = _fitted(work, rows, labels, label, F.lit(False) if out is None else out, bound, size, k)
    work.drop("examples")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Scores(index.value, steps, terms.value, k)
        for batch in batches:
            score, evidence = reader.of(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array(evidence, pa.list_(pa.int64()))], ["doc_id", "score", "evidence"]
            )

    return rows.mapInArrow(tidy(make), "doc_id bigint, score double, evidence array<bigint>")


def without_toxic(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, bound: int = EXAMPLES
) -> DataFrame:
    """The documents scored below the threshold, with all their columns, by every label; texts are not shuffled."""
    work = Work(docs.sparkSession, "toxicity")
    index, steps, terms = _fitted(work, docs, labels, label, F.lit(False), bound, EXAMPLE_BYTES, NEAREST)
    work.close()

    def kept(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = _Scores(index.value, steps, terms.value, NEAREST)
        for column in texts:
            yield pa.array(reader.of(column)[0] < threshold)
        del reader
        release_memory()

    # Only texts go to Python and only verdicts come back.
    return docs.where(F.arrow_udf(kept, "boolean")(F.col("text")))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "toxicity")
    out = held_out(5, 0)
    found = scored(work, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", out)
    return work.result(found.select(
        "doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence"
    ))
