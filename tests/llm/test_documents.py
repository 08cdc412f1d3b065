import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from quarrymill.llm import labelled, packing, quality_classifier, quality_rules, toxicity
from quarrymill.llm import kernels as K
from quarrymill.llm.work import Work
from tests.llm.fixtures import documents, texts, words


def test_quality_rules_equal_their_sql(spark):
    rows = [*texts(), "a b c d e " * 4, "x y\nx y\n \nx y", "é#*$ é", "\n\n", "w " * 4 + "z"]
    docs = documents(spark, rows)
    con = duckdb.connect()
    documents_table = docs.toPandas()[["doc_id", "text"]]  # noqa: F841
    con.execute("create table documents as select * from documents_table")
    want = {r[0]: r[1:] for r in con.execute(quality_rules.OP10_SQL).fetchall()}
    found = quality_rules.ledger(docs.repartition(3)).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.failures & 3 != 0, r.failures == 0, r.failures) for r in found}
    assert got == want
    for r in found:
        w = re.findall(r"[^\x20\x09-\x0D]+", rows[r.doc_id // 3] or "")
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        assert r.n_repeat_words == len({i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)})
    assert quality_rules.ledger(documents(spark, [])).count() == 0


def test_policies_and_ablation(spark):
    book = quality_rules.ledger(documents(spark)).cache()
    masks = [r.failures for r in book.collect()]
    policy = quality_rules.DEFAULT_POLICY
    kept = quality_rules.apply_policy(book, policy).where("kept").count()
    assert kept == sum(m & policy.mask == 0 for m in masks)
    for r in quality_rules.ablation(book, policy).collect():
        bit = 1 << [n for n, _ in quality_rules.RULES].index(r.rule)
        assert (r.n_failed, r.n_failed_alone) == (sum(m & bit != 0 for m in masks), sum(m & policy.mask == bit for m in masks))
        assert r.n_kept_without == sum(m & policy.mask & ~bit == 0 for m in masks)
    kept_rows = quality_rules.filter_documents(documents(spark))
    assert kept_rows.columns == documents(spark).columns and kept_rows.count() == kept


def labelled_docs(spark, n=600):
    rows, labels = [], []
    for i in range(n):
        w = words(i, 40)
        bad, low = i % 5 == 0, i % 7 == 0
        if bad:
            w[3], w[20] = ("vile", "nasty") if i % 2 else ("nastier", "vile")
        if low:
            w = [x + "***" for x in w]
        rows.append((i, " ".join(w), "en", "s", 1))
        if i % 3:
            labels.append((i, 0 if low else 1, int(bad)))
    rows += [(n, None, "en", "s", 0), (n + 1, "", "en", "s", 0), (n + 2, "  \n", "en", "s", 0), (None, "vile nasty", "en", "s", 0), (5, "w vile nasty", "en", "s", 0)]
    labels += [(3, None, None), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = labelled_docs(spark)
    found = toxicity.scored(Work(spark, "t"), docs, labels, "toxic", labelled.held_out(5, 0)).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 600 and r.doc_id != 5:
            assert (r.score >= 0.5) == (r.doc_id % 5 == 0), r
    none = toxicity.scored(Work(spark, "t"), docs, labels.limit(0)).collect()
    assert len(none) == docs.count() and len({r.score for r in none}) == 1
    assert toxicity.scored(Work(spark, "t"), docs.limit(0), labels).count() == 0
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 600 and r.doc_id != 5} == {i for i in range(600) if i % 5}


def test_quality_classifier(spark):
    docs, labels = labelled_docs(spark)
    model = quality_classifier.fit(docs, labels, "quality", labelled.held_out(4, 2))
    for r in quality_classifier.scored(docs, model).collect():
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 600 and r.doc_id != 5:
            assert (r.score >= 0.7) == (r.doc_id % 7 != 0)
    bare = quality_classifier.fit(docs, labels.limit(0))
    assert {r.score for r in quality_classifier.scored(docs, bare).collect()} == {0.5}
    assert quality_classifier.scored(docs.limit(0), model).count() == 0


def test_dual_coordinate_descent_meets_its_optimality_conditions():
    r = np.random.default_rng(2)
    rows = [np.unique(np.append(0, r.integers(64, 164, 12))) for _ in range(200)]
    y = np.array([float(x.sum() % 3 > 0) for x in rows])
    scale = quality_classifier.ratios(rows, y)
    w = quality_classifier.descend(rows, y, scale, 0.1, 400)
    sign, most = np.where(y > 0, 1, -1), 0.1 * 0.5 / np.where(y > 0, y.mean(), 1 - y.mean())

    def objective(v):
        margins = np.array([s * (v[x] * scale[x]).sum() for s, x in zip(sign, rows)])
        return 0.5 * v @ v + (most * np.maximum(0, 1 - margins)).sum()

    best = objective(w)
    for _ in range(50):
        step = np.zeros(len(w))
        step[r.integers(64, 164, 20)] = r.normal(size=20) * 0.01
        assert objective(w + step) >= best - 1e-3


def test_isotonic():
    x, rate = labelled.isotonic(np.array([3.0, 1, 2, 2]), np.array([1.0, 0, 1, 0]), np.array([1.0, 1, 1, 1]))
    assert (np.diff(x) > 0).all() and (np.diff(rate) >= 0).all()


def test_kernels_hash_by_content():
    from tests.llm.test_repeats import mixed

    import pyarrow as pa

    given = [t for t in mixed(4)]
    seen: dict[int, str] = {}
    for part in K.slices(pa.array(given), 500):
        starts, ends, lo, hi = part.words()
        hashes = part.word_hashes(starts, ends)
        for i in range(part.n):
            w = (given[part.row + i] or "").split()
            assert [bytes(part.data[a:b]).decode() for a, b in zip(starts[lo[i] : hi[i]], ends[lo[i] : hi[i]])] == w
            for h, x in zip(hashes[lo[i] : hi[i]].tolist(), w):
                assert seen.setdefault(h, x) == x
    h = np.random.default_rng(0).integers(0, 1 << 63, 200, dtype=np.uint64)
    for width in (1, 2, 3, 7, 64):
        assert K.minimizers(h, width).tolist() == [i + int(np.argmin(h[i : i + width] >> np.uint64(24))) for i in range(200 - width + 1)]


def test_long_rows_are_done_in_parts():
    h = np.random.default_rng(3).integers(0, 1 << 63, 300, dtype=np.uint64)
    for step in (16, 17, 100, 299):
        for width in (1, 4, 7):
            assert K.minimizers(h, width, step).tolist() == K.minimizers(h, width).tolist()


def test_pipeline_stages(spark, tmp_path):
    docs, labels = labelled_docs(spark)
    docs = docs.where("doc_id is not null").union(documents(spark).select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 1000))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    given = spark.read.parquet(str(tmp_path / "documents.parquet"))
    now = given
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / f"stage-{k}")
        stage(spark, now, str(tmp_path)).write.parquet(out)
        after = spark.read.parquet(out)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == given.columns and 0 < after.count() <= now.count(), name
            now = after
    pieces = spark.read.parquet(out)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in now.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == pieces.count()
    assert packing.WINDOW == 4096
