import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarrymill.llm import bpe, packing, tokens
from quarrymill.llm.work import Work
from tests.llm.fixtures import documents, texts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_vocabulary())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_texts(n):
    r = random.Random(5)
    letters = [chr(c) for c in [*range(0, 0x180), *range(0x300, 0x320), *range(0x391, 0x3CA), 0x130, 0x1E9E, 0x2003, 0x2028, 0x3000]]
    letters += ["<|endoftext|>", "'s", "'re", " ", "\n", "the", "aaaa"]
    return ["".join(r.choice(letters) for _ in range(r.randint(1, 12))) for _ in range(n)]


def test_encoders_equal_the_library(library):
    dynamic, cached = bpe.PrefixEncoder(tokens.default_vocabulary()), tokens.Encoder(tokens.default_vocabulary())
    cases = odd_texts(5000) + [t for t in texts() if t]
    found = cached.encode(cases)
    for text, ids in zip(cases, found):
        want = ids_of(library, text)
        assert dynamic.encode(text) == want, text
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert dynamic.decode(want) == library.decode(want, skip_special_tokens=False)


def test_generations_of_seen_chunks(library, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNKS", 3)
    encoder = tokens.Encoder(tokens.default_vocabulary())
    assert encoder.chunks.most == 3
    for text in ("a b c d", "a e f g", "a b h", "a b c d e f g h"):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids_of(library, text)


def test_orc_round_trip(spark, library, tmp_path):
    docs = documents(spark)
    path = str(tmp_path / "ids")
    tokens.write_token_ids(docs.repartition(3), path)
    rows = tokens.read_token_ids(spark, path)
    got = {r.doc_id: r for r in tokens.digests(rows).collect()}
    kept = {r.doc_id: list(r.ids) for r in rows.collect()}
    start = 0
    for i, text in enumerate(texts()):
        want = ids_of(library, text) + [2]
        r = got[i * 3 + 1]
        assert kept[r.doc_id] == want
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), crc(want))
        start += len(want)
    assert len(got) == len(texts())
    plan = rows.where("doc_id = 4")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,4)]" in plan


def test_orc_of_equal_and_null_ids_and_of_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(None, "b"), (1, "d"), (1, "c"), (None, None)], "doc_id bigint, text string")
    tokens.write_token_ids(docs, str(tmp_path / "ties"))
    rows = tokens.digests(tokens.read_token_ids(spark, str(tmp_path / "ties"))).collect()
    assert sorted((r.start, r.n_tokens) for r in rows) == [(0, 1), (1, 2), (3, 2), (5, 2)]
    tokens.write_token_ids(docs.limit(0), str(tmp_path / "none"))
    assert tokens.digests(tokens.read_token_ids(spark, str(tmp_path / "none"))).count() == 0


def test_bpe_digests(spark, library):
    got = {r.doc_id: r for r in bpe.digests(documents(spark)).collect()}
    whole = {r.doc_id: r for r in bpe.encoded(documents(spark)).collect()}
    for i, text in enumerate(texts()):
        ids = ids_of(library, text)
        back = library.decode(ids, skip_special_tokens=False)
        r = got[i * 3 + 1]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
        assert (list(whole[r.doc_id].ids), whole[r.doc_id].decoded) == (ids, back)
    assert bpe.digests(documents(spark, [])).count() == 0


def check_packing(rows, ids, window):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length]) and r.length > 0
        assert r.doc_tokens == len(ids[r.doc_id])
    assert by_doc.keys() == ids.keys()
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[doc])
    for k, pieces in by_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or k == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


@pytest.mark.parametrize("window", [64, 4096])
def test_packing(spark, library, window):
    ids = {i * 3 + 1: ids_of(library, t) + [2] for i, t in enumerate(texts())}
    docs = documents(spark).repartition(3)
    check_packing(packing.packed(docs, window=window).collect(), ids, window)
    check_packing(packing.packed(docs, window=window, weights={"src1": 3.0, "src2": 1.0}).collect(), ids, window)
    assert packing.packed(documents(spark, []), window=window).count() == 0


def test_windows_hold_the_shares(spark):
    rows = [(i, "word " * (20 + i % 50), "abc"[i % 3]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    source = {i: s for i, _, s in rows}
    shares = {"a": 0.5, "b": 0.25, "c": 0.25}
    found = packing.packed(docs, weights=shares, window=512).collect()
    taken, emptied = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for r in found:
        taken[r.sequence_id][source[r.doc_id]] += r.length
        emptied[source[r.doc_id]] = max(emptied[source[r.doc_id]], r.sequence_id)
    full = range(min(emptied.values()))
    assert len(full) > 10
    for k in full:  # every window holds the shares to a few tokens
        assert all(abs(taken[k][s] - shares[s] * 512) <= 3 for s in shares), taken[k]


def test_default_shares_hold_in_every_window(spark):
    rows = [(i, "word " * (5 + i * i % 400), "s%d" % min(i % 13, 8)) for i in range(1200)]
    docs = spark.createDataFrame(rows + [(None, None, None)], "doc_id bigint, text string, source string")
    source = {i: s for i, _, s in rows}
    found = packing.packed(docs).collect()
    taken, total = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for r in found:
        taken[r.sequence_id][source.get(r.doc_id)] += r.length
        total[source.get(r.doc_id)] += r.length
    every = sum(total.values())
    far = [sum(abs(taken[k][s] / 4096 - total[s] / every) for s in total) / 2 for k in range(every // 4096)]
    assert len(far) > 30 and np.mean(far) < 0.01 and max(far) < 0.03
    assert all(0 <= r.deficit < 4096 for r in found)
    assert Work(spark, "x").root
