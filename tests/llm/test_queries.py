"""Every registered query over a small folder of tables: contracts, SQL where there is some, definitions where there is none."""

import hashlib
import json
import math
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from quarrymill.llm import queries, quality_classifier, tokens
from quarrymill.llm import kernels as K
from tests.llm.fixtures import texts, words

COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op3_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op4_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op5_token_ids": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op6_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op7_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op8_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op9_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with nulls, copies, very long texts and further columns whose names operators use themselves."""
    where = str(tmp_path_factory.mktemp("tables"))
    given = texts() + [" ".join(words(500 + i, 30) + (["vile", "nasty"] if i % 4 == 0 else [])) + (" !!!" * (i % 3)) for i in range(80)]
    docs = [(i * 3 + 1, t, "en", None if i % 7 == 0 else f"src{i % 3}", len(t or ""), i, "x", 0.5, "fp") for i, t in enumerate(given)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, uid bigint, hits string, score double, fp string"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{where}/documents.parquet")
    labels = [(d, None if i % 9 == 0 else int(i % 3 > 0), int("vile" in (t or ""))) for i, (d, t, *_) in enumerate(docs) if i % 5]
    spark.createDataFrame(labels + [(None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    r = np.random.default_rng(3)
    base = r.normal(size=(6, 8))
    vectors = [(i, [float(np.float32(x)) for x in base[i % 6] + r.normal(size=8) * 0.1], i % 2) for i in range(60)]
    vectors += [(60, None, 1), (61, [0.0] * 8, 1), (62, vectors[0][1], 0), (63, vectors[0][1], None), (64, [1.0, None], 0)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 as size", "2 as v").write.parquet(f"{where}/embeddings.parquet")
    return where, {d: t for d, t, *_ in docs}


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_registered_query(spark, folder, name):
    where, text = folder
    query = queries.queries()[name]
    found = query(spark, where)
    assert found.columns[: len(COLUMNS[name])] == COLUMNS[name]
    rows = found.collect()
    n = 65 if "embedding" in name else len(text)
    assert name == "op7_packing" or len(rows) == n
    if sql := queries.oracle_sql().get(name):
        con = duckdb.connect()
        for t in ("documents", "labels", "embeddings"):
            con.execute(f"create view {t} as select * from '{where}/{t}.parquet/*.parquet'")
        want = con.execute(f"select {', '.join(found.columns)} from ({sql})").fetchall()
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
        return
    library = Tokenizer.from_file(tokens.default_vocabulary())
    if name in ("op1_toxicity", "op4_quality_classifier"):
        modulus, remainder, least = (5, 0, 0.5) if name == "op1_toxicity" else (4, 2, 0.7)
        for r in rows:
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= least)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder)
    elif name == "op5_token_ids":
        start = 0
        for r in sorted(rows, key=lambda r: r.doc_id):
            want = ids(library, text[r.doc_id]) + [2]
            assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), crc(want))
            start += len(want)
    elif name == "op9_bpe":
        for r in rows:
            want = ids(library, text[r.doc_id])
            assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    else:
        taken = {}
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            want = ids(library, text[r.doc_id]) + [2]
            assert r.doc_tokens == len(want) and r.ids_crc32 == crc(want[r.start : r.start + r.length])
            assert r.offset == taken.get(r.sequence_id, 0)
            taken[r.sequence_id] = r.offset + r.length
        assert sum(taken.values()) == sum(len(ids(library, t)) + 1 for t in text.values())
        assert all(x == 4096 for k, x in taken.items() if k < max(taken)) and max(taken.values()) <= 4096


def test_quality_features_are_ngrams_of_words():
    """Equal n-grams have one place, others another; ratios are log ratios of smoothed shares."""
    import pyarrow as pa

    given = [t for t in texts() if t and len(t) < 20_000]
    names: dict[int, set] = {}
    rows = [x for part in K.slices(pa.array(given)) for x in quality_classifier.features(part)]
    for t, x in zip(given, rows):
        w = K._LOWER[np.frombuffer(t.encode(), np.uint8)].tobytes().split()
        grams = {tuple(w[i : i + k]) for k in (1, 2) for i in range(len(w) - k + 1)}
        places = x[x >= quality_classifier.SHAPES]
        assert len(grams) - 8 <= len(places) <= len(grams)  # a few may share a place
        for p in places.tolist():
            names[p] = names[p] & grams if p in names else grams
    assert sum(not g for g in names.values()) <= 20
    y = np.array([float(i % 3 > 0) for i in range(len(rows))])
    found = quality_classifier.ratios(rows, y)
    counts = [{}, {}]
    for x, label in zip(rows, y):
        for p in x.tolist():
            counts[int(label)][p] = counts[int(label)].get(p, 0) + 1
    totals = [sum(c.values()) + quality_classifier.PLACES for c in counts]
    for p in list(names)[:300]:
        assert math.isclose(found[p], math.log((counts[1].get(p, 0) + 1) / totals[1]) - math.log((counts[0].get(p, 0) + 1) / totals[0]), rel_tol=1e-9)
    assert json.dumps(COLUMNS)
