import random
import re

import numpy as np
import pytest

from quarrymill.llm import embeddings, minhash
from quarrymill.llm import repeats as R
from quarrymill.llm.work import Work, components
from tests.llm.fixtures import documents, texts, words


def roots(n, linked):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def near_copies(seed):
    r = random.Random(seed)
    out = []
    for g in range(6):
        base = words(seed * 50 + g, r.randint(20, 200))
        for _ in range(12):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 20))):
                w[r.randrange(len(w))] = r.choice(["new", "Other", "x" * r.randint(1, 5)])
            out.append(" ".join(w))
    return out + texts()


def test_components(spark):
    r = random.Random(3)
    n = 300
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)]
    pairs += [(r.randrange(160, n), r.randrange(160, n)) for _ in range(90)] + [(5, 5), (None, 3)]
    both = {frozenset(p) for p in pairs if None not in p}
    want = {i: x for i, x in enumerate(roots(n, lambda i, j: frozenset((i, j)) in both)) if i != x}
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    assert {x.node: x.root for x in components(Work(spark, "t"), edges, "c").collect()} == want


@pytest.mark.parametrize(("seed", "width", "rows", "shingle_count"), [(1, 4, 2048, 10**6), (2, 4, 3, 400), (3, 5, 2048, 10**6)])
def test_minhash(spark, seed, width, rows, shingle_count):
    given = near_copies(seed)
    docs = documents(spark, given).repartition(3)
    sets = [shingles(t, width) for t in given]
    want = roots(len(given), lambda i, j: bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    work = Work(spark, "t")
    found = minhash.near_duplicates(work, R.keyed(work, docs), width, 80, rows, shingle_count).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found}
    assert got == {i * 3 + 1: (len(s), want[i] * 3 + 1, want[i] == i) for i, s in enumerate(sets)}


def test_minhash_keeps_one_of_each_group(spark):
    rows = [(2, "a b c d e f g"), (1, "a b c d e f g"), (None, "A b c d e f g"), (1, "a b c d e f g"), (7, None), (8, ""), (None, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 as uid", "2 as root", "3 as n")
    found = minhash.deduplicated(docs)
    assert found.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in found.collect()) == [(0, "z"), (1, "a b c d e f g"), (7, ""), (8, "")]
    assert minhash.deduplicated(docs.limit(0)).count() == 0


def test_estimate_is_corrected_for_chance():
    r = np.random.default_rng(1)
    common = r.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
    sets = [np.concatenate([common, r.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2)]) for k in (500, 500)]
    both = minhash.packed(np.stack([minhash.minima(x) for x in sets])).view(np.uint64)
    assert abs(minhash.estimated(both[0], both[1]) - 0.8) < 0.15


@pytest.mark.parametrize(("least", "size"), [(0.98, 256), (0.9, 8)])
def test_embeddings(spark, least, size):
    r = np.random.default_rng(4)
    centers = r.normal(size=(12, 16))
    rows = []
    for i in range(240):
        v = centers[i % 12] + r.normal(size=16) * r.choice([0.02, 0.1, 0.3])
        rows.append((i * 2, [float(x) for x in v.astype(np.float32)], int(i % 3) if i % 40 else None))
    rows += [(1, None, 1), (3, [0.0] * 16, 1), (5, [1.0, None], 1), (7, [float("nan")] * 16, 1), (9, [float("inf")] + [0.0] * 15, 1), (11, [], 1)]
    rows += [(13 + 2 * i, rows[4][1], rows[4][2]) for i in range(30)] + [(81, [1.0, 2.0], 1), (83, [2.0, 4.0], 1)]
    usable = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) and k is not None for _, v, k in rows]

    def linked(i, j):
        (_, a, k), (_, b, m) = rows[i], rows[j]
        if not (usable[i] and usable[j] and k == m and len(a) == len(b)):
            return False
        a, b = np.array(a), np.array(b)
        return (a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= least

    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    rows, usable = [rows[i] for i in order], [usable[i] for i in order]
    want = roots(len(rows), linked)
    n_links = [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    given = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    found = embeddings.near_duplicates(Work(spark, "t"), given, least, size=size).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert got == {rows[i][0]: (n_links[i], rows[want[i]][0], want[i] == i) for i in range(len(rows))}


def test_embeddings_with_equal_ids_and_without_rows(spark):
    schema = "vec_id bigint, embedding array<double>, label int"
    given = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, None, None)], schema)
    found = embeddings.near_duplicates(Work(spark, "t"), given).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept, r.stays) for r in found) == [
        (0, 0, 0, True, True), (0, 2, 1, False, False), (1, 2, 1, True, False), (1, 2, 1, True, True),
    ]
    doubles = spark.createDataFrame([(1, [1.0, 0.1], 1), (2, [2.0, 0.2], 1), (3, [1e300, 1e299], 1), (4, [1.0, 0.5], 1)], schema)
    assert sorted((r.vec_id, r.n_links) for r in embeddings.near_duplicates(Work(spark, "t"), doubles).collect()) == [(1, 2), (2, 2), (3, 2), (4, 0)]
    assert embeddings.near_duplicates(Work(spark, "t"), given.limit(0)).count() == 0
