import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from quarrymill.llm import substring_dedup, suffix_dedup
from quarrymill.llm.work import Work
from tests.llm.fixtures import documents, texts, words


def mixed(seed):
    """Texts cut from a few passages, with overlaps, periods and copies."""
    r = random.Random(seed)
    sources = [words(seed * 10 + i, 60) for i in range(4)]
    out = []
    for _ in range(60):
        made = []
        for _ in range(r.randint(0, 4)):
            s = r.choice(sources)
            a = r.randrange(50)
            made += s[a : a + r.randint(1, 60)] if r.random() < 0.7 else words(r.randrange(10**6), r.randint(1, 30))
        out.append(" ".join(made))
    return [*out, "ab " * 90, "ab " * 40, "é" * 300, None, "", out[0], out[1]]


def covered(sequences, window):
    """For each sequence the marks of the units that a repeated window covers, by counting all windows."""
    seen = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        mark = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] > 1:
                mark[i : i + window] = [True] * window
        out.append(mark)
    return out


def expected_words(given, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in given]
    return [
        (len(s), sum(m), hashlib.sha256(" ".join(w for w, x in zip(s, m) if not x).encode()).hexdigest())
        for s, m in zip(split, covered(split, window))
    ]


def expected_bytes(given, window):
    split = [(t or "").encode() for t in given]
    return [
        (len(s), sum(m), sum(x and not y for x, y in zip(m, [False, *m])), hashlib.sha256(bytes(b for b, x in zip(s, m) if not x)).hexdigest())
        for s, m in zip(split, covered(split, window))
    ]


@pytest.mark.parametrize(("given", "window", "run"), [(texts, 35, 8), (lambda: mixed(1), 35, 8), (lambda: mixed(2), 12, 5)])
def test_substring_dedup(spark, given, window, run):
    docs = documents(spark, given()).repartition(3)
    rows = substring_dedup.digests(Work(spark, "t"), docs, window, run, 3).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows}
    assert got == {i * 3 + 1: x for i, x in enumerate(expected_words(given(), window))}


@pytest.mark.parametrize("variants", [4096, 1])
@pytest.mark.parametrize(("given", "window", "run"), [(texts, 200, 64), (lambda: mixed(1), 200, 64), (lambda: mixed(3), 51, 20)])
def test_suffix_dedup(spark, given, window, run, variants, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN", run)
    docs = documents(spark, given()).repartition(3)
    rows = suffix_dedup.digests(Work(spark, "t"), docs, window, run, variants).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert got == {i * 3 + 1: x for i, x in enumerate(expected_bytes(given(), window))}


def test_equal_and_null_ids_and_no_rows(spark):
    passage = " ".join(words(9, 50))
    docs = spark.createDataFrame([(1, passage), (1, passage), (None, None), (None, passage + " more")], "doc_id bigint, text string")
    rows = substring_dedup.digests(Work(spark, "t"), docs).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in rows) == [(0, 0, 0), (0, 51, 50), (1, 50, 50), (1, 50, 50)]
    rows = suffix_dedup.digests(Work(spark, "t"), docs).collect()
    n = len(passage)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in rows) == [(0, 0, 0), (0, n + 5, n), (1, n, n), (1, n, n)]
    assert substring_dedup.digests(Work(spark, "t"), docs.limit(0)).count() == 0
    assert suffix_dedup.digests(Work(spark, "t"), docs.limit(0)).count() == 0


def test_deduplicated_keeps_rows_and_columns(spark):
    docs = documents(spark, mixed(1))
    found = suffix_dedup.deduplicated(docs)
    assert found.schema.names == docs.schema.names
    want = {}
    for i, (t, m) in enumerate(zip(mixed(1), covered([(t or "").encode() for t in mixed(1)], 200))):
        kept = bytes(b for b, x in zip((t or "").encode(), m) if not x).decode("utf-8", "ignore")
        want[i * 3 + 1] = None if t is None else kept
    assert {r.doc_id: r.text for r in found.collect()} == want


@pytest.mark.parametrize("letters", [1, 2, 4, 200])
def test_suffix_array(letters):
    r = np.random.default_rng(letters)
    for n in [*range(1, 30), 100, 301, 1000]:
        s = r.integers(1, letters + 1, n)
        data = s.tolist()
        assert suffix_dedup.suffix_array(s, letters, 10**9).tolist() == sorted(range(n), key=lambda i: data[i:])
        for need in (2, 5, 20, 100):
            order = suffix_dedup.suffix_array(s, letters, need).tolist()
            heads = [data[i : i + need] for i in order]
            assert sorted(order) == list(range(n))
            assert heads == sorted(heads)


def test_later_sessions_add_batches_without_shuffling_history(spark, tmp_path):
    """A later batch finds what it repeats of history, history's own windows become hits, and runs are compacted."""
    root, passage = str(tmp_path / "index"), words(9, 60)
    given = [" ".join(passage), " ".join(words(21, 60)), " ".join(words(22, 10) + passage[:36]), None, " ".join(passage[5:50] + words(23, 5)), " ".join(words(24, 60))]
    corpus = spark.createDataFrame(list(enumerate(given)), "uid bigint, text string")
    for i in range(len(given)):
        session = spark.newSession()
        every = session.createDataFrame(list(enumerate(given)), "uid bigint, text string")
        index = substring_dedup.FingerprintIndex(session, root, 35, 8, most_runs=2)
        index.append(every.where(f"uid = {i}"), every)
        assert len(index.runs["anchors"]) <= 2 and index.made > i
        now = [[False] * len((t or "").split()) for t in given[: i + 1]]
        for h in index.hits().collect():
            now[h.uid][h.first : h.first + h.n + 34] = [True] * (h.n + 34)
        assert now == covered([(t or "").split() for t in given[: i + 1]], 35)
        if len(index.runs["anchors"]) == 2:
            for family, (first, last) in index.runs.items():
                plan = index.met(family, last, [first])._jdf.queryExecution().executedPlan().toString()
                assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        index.close()
    assert corpus.count() == len(given)
