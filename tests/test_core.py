import random
import re
import unicodedata
import zipfile

import pytest
from pyspark.sql import functions as F

from quarrymill.functions import gates as G
from quarrymill.functions import outputs
from quarrymill.functions import text as T
from quarrymill.operators import chunk, dedup, merge, profile, search
from quarrymill.plans import generate, premium
from quarrymill.sources import files, sinks
from quarrymill.streaming import resume


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first().x


def texts(n, seed=1):
    r = random.Random(seed)
    letters = list("ab Éé.,!?;: \t\n") + ["...", "the ", "www.x.y ", "a@b.cd ", " ", "é", "Scrum master ", "3.14", "’"]
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_counts_follow_python(spark):
    rows = texts(400)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    c = F.col("t")
    found = df.select("i", T.word_count(c).alias("w"), T.period_count(c).alias("p"), T.strip(c).alias("s"), T.normalized(c).alias("n"),
                      T.short_key(c).alias("k"), T.has_echo(c).alias("e"), T.is_repetitive(c).alias("r"), T.compose(c).alias("c")).collect()
    for r in found:
        t = rows[r.i]
        w = t.lower().split()
        assert (r.w, r.p, r.s) == (len(t.split()), t.count("."), t.strip())
        assert r.n == re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", t.lower())).strip()
        assert r.k == re.sub(r"\W+", "", t.lower())[:70]
        assert r.e == any(a == b and len(a) > 3 for a, b in zip(w, w[1:]))
        grams = [tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)]
        assert r.r == (len(t.split()) >= 10 and any(grams.count(g) > 2 for g in grams))
        assert r.c == unicodedata.normalize("NFC", t).replace("​", "").replace("﻿", "")


@pytest.mark.parametrize(("given", "want"), [
    ("wait... what", "Wait... what."), ("so 3.14 , ok", "So 3. 14, ok."), ("see https://x.y/z now", "See now."),
    ("ask a@b.com please", "Ask please."), ("the scrum MASTER and Agile", "The Scrum Master and Agile."), ("a\tb  c !", "A b c!"),
    (None, ""), ("", ""), ("what ?? no", "What? ? no."),
])
def test_cleaning(spark, given, want):
    assert one(spark, given, lambda c: T.clean_text(c, "en")) == want


def test_french_and_documents(spark):
    assert one(spark, "« bon »  l' eau", lambda c: T.clean_text(c, "fr")) == "« bon » l'eau."
    assert one(spark, "a\n\n\n\nb’œ€é ", T.clean_document) == "a\n\nbé"
    assert one(spark, "ا" * 21, T.detect_language) == "arabic"
    assert one(spark, " le la les et dans the ", T.detect_language) == "french"
    assert one(spark, "plain", T.detect_language) == "english"


def test_gates(spark):
    assert one(spark, "What is [this]?", T.has_placeholder) and not one(spark, "plain", T.has_placeholder)
    assert not one(spark, "Good. bad start", T.grammar_ok) and one(spark, "Good. Start", T.grammar_ok)
    assert one(spark, "I don't know, but it is a very long answer indeed", T.low_information)
    row = spark.createDataFrame([("x" * 20, "word " * 60 + ". . . . .")], "q string, a string")
    assert row.select(G.generation_reason(F.col("q"), F.col("a")).alias("r")).first().r == "few_content_words"
    assert row.select(G.final_reason(F.col("q"), F.lit(None).cast("string")).alias("r")).first().r == "empty"
    score = row.select(G.quality_score(F.lit("short"), F.lit("bad answer"), ("risk",)).alias("s")).first().s
    assert score == 10 - 2 - 2 - 1.5 - 2 - 1


def test_outputs():
    text = 'Sure\n```json\n[{"instruction": "a", "response": "b",}, {"x": 1}]\n```'
    assert outputs.pairs(text) == [{"instruction": "a", "response": "b"}, {"x": 1}]
    assert outputs.pairs('noise {"instruction": "a", "response": "b"} more') == [{"instruction": "a", "response": "b"}]
    assert outputs.pairs(r'[{"instruction": "say \"x\"", "response": "b"}]') == []
    assert len(outputs.pairs(r'[{"instruction": "say \"x\"", "response": "b"}]', strict=True)) == 1
    assert outputs.pairs(None) == [] and outputs.pairs("[{broken") == []


def test_question_and_answer_of_free_text(spark):
    answer = "word " * 60
    got = one(spark, f"Question: how does it work?\n\n{answer}\nmore", T.split_question_answer)
    assert got.instruction == "how does it work?" and got.response == answer.strip() + " more"
    assert one(spark, "short", T.split_question_answer) is None
    assert one(spark, "<s>[INST] q [/INST] first\n\nsecond", T.last_reply) == "first"
    assert one(spark, "Q: 'how is it done'\nrest", T.clean_generated_question) == "how is it done'"


def test_chunks_follow_a_fold(spark):
    r = random.Random(2)
    rows = [(i, "\n\n".join("p" * r.randint(0, 400) + str(k) for k in range(r.randint(1, 30)))) for i in range(12)]
    want = {}
    for i, t in rows:
        done, now = [], ""
        for p in t.split("\n\n"):
            if len(now) + len(p) > 900 and now:
                done.append(now.strip())
                now = (now[-100:] if len(now) > 100 else now) + "\n\n" + p
            else:
                now = now + "\n\n" + p if now else p
        want[i] = done + ([now.strip()] if now else [])
    found = chunk.chunk_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), 900, 100).collect()
    assert sorted(x.chunk_id for x in found) == list(range(1, sum(map(len, want.values())) + 1))
    for i, chunks in want.items():
        assert [x.text for x in sorted((x for x in found if x.doc_id == i), key=lambda x: x.chunk_index)] == chunks


def greedy(sets, percent):
    gone = set()
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            if i not in gone and j not in gone and sets[i] and sets[j]:
                if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    gone.add(j)
    return [i not in gone for i in range(len(sets))]


def test_greedy_near_duplicates(spark):
    """Chains and forks too: rows that are removed remove nothing."""
    r = random.Random(5)
    rows = [f"w{i} " + " ".join(f"x{k}" for k in range(20) if k != i % 3) for i in range(6)]
    base = [f"t{k}" for k in range(40)]
    for _ in range(60):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(40)] = f"n{r.randrange(30)}"
        rows.append(" ".join(w))
    rows += ["", None, rows[0], rows[8].upper()]
    docs = spark.createDataFrame(list(enumerate(rows)), "idx bigint, text string").repartition(3)
    want = greedy([set((t or "").lower().split()) for t in rows], 85)
    assert {x.idx: x.kept for x in dedup.greedy_kept(docs).collect()} == dict(enumerate(want))


def test_best_of_key_keeps_the_longest_and_the_earliest(spark):
    qa = spark.createDataFrame([(0, "k", "aa"), (1, "k", "bbb"), (2, "k", "ccc"), (3, None, "d")], "idx bigint, key string, response string")
    found = {(x.key, x.idx, x.first_idx) for x in dedup.best_of_key(qa, "key").collect()}
    assert found == {("k", 1, 0), (None, 3, 3)}


def test_split_sizes_and_order(spark):
    rows = spark.range(15_352).withColumnRenamed("id", "idx").repartition(5)
    counts = {x.split: x["count"] for x in merge.split(rows).groupBy("split").count().collect()}
    assert counts == {"test": 768, "val": 2303, "train": 12281}
    assert sorted(x.position for x in merge.shuffled(rows.limit(50)).collect()) == list(range(50))


def test_topk(spark):
    rows = [(i, [float((i * 7 + k * 3) % 5), float(k == i % 4), 1.0]) for i in range(40) for k in [i % 6]] + [(99, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    assert search.cosine_topk(df, df.where("id % 10 = 0"), 3, 7).groupBy("query").count().where("count <> 3").count() == 0


def test_profile_bins_have_gaps(spark):
    qa = spark.createDataFrame([("w " * 1200,), ("w " * 40,)], "response string")
    found = {x.low: x.n for x in profile.bins(qa, T.word_count(F.col("response")), profile.WORD_BINS).collect()}
    assert found == {0: 0, 30: 1, 50: 0, 80: 0, 120: 0}


def test_files_and_sinks(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("plain é", encoding="utf-8")
    (folder / "b.txt").write_bytes(b"\xff\xfe")
    body = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>one</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>two</w:t></w:r></w:p></w:body></w:document>'
    with zipfile.ZipFile(folder / "c.docx", "w") as z:
        z.writestr("word/document.xml", body)
    found = {x.filename: (x.text, x.status) for x in files.documents(spark, str(folder)).collect()}
    assert found == {"a.txt": ("plain é", "ok"), "b.txt": ("", "error"), "c.docx": ("one\n\ntwo", "ok")}
    qa = spark.createDataFrame([("q1", "a\n1", "en"), ("q2", "a2", "fr")], "instruction string, response string, language string")
    out = str(tmp_path / "chats")
    assert sinks.write_chats(qa, out) == 2
    spark.createDataFrame([("not json",), ("{}",)], "value string").write.mode("append").text(out)
    back = files.qa_from_chats(spark, out, augmentation=True).orderBy("instruction").collect()
    assert [(x.instruction, x.response, x.category, x.augmentation_type) for x in back] == [("q1", "a\n1", "general", "original"), ("q2", "a2", "general", "original")]
    sinks.write_by_language(qa, str(tmp_path / "by"))
    assert files.first_existing(spark, str(tmp_path / "no"), str(tmp_path / "by/by_language/language=fr")).endswith("fr")
    assert sum(x.lines for x in sinks.manifest(spark, out).collect()) == 4
    (tmp_path / "w.json").write_text('{"qa_pairs": [{"instruction": "x", "response": "y"}], "stats": {"n": 1}}')
    assert [(x.idx, x.instruction, x.category) for x in files.any_layout(spark, str(tmp_path / "w.json")).collect()] == [(0, "x", None)]


def test_simple_pdfs_without_a_library():
    import zlib

    def pdf(*streams):
        parts = [b"%PDF-1.4\n"]
        for i, (kind, body) in enumerate(streams):
            parts.append(b"%d 0 obj\n<< /Length %d %s>>\nstream\n%s\nendstream\nendobj\n" % (i + 1, len(body), kind, body))
        return b"".join(parts)

    first = rb"BT /F1 12 Tf 72 700 Td (Hello \(world\)) Tj 0 -14 Td [(sp) -20 (lit \351)] TJ ET"
    second = zlib.compress(rb"BT 1 0 0 1 0 0 Tm <4142> Tj T* (end) ' ET")
    assert files.plain_pdf_text(pdf((b"", first), (b"/Filter /FlateDecode ", second))) == "Hello (world)\nsplit é\nAB\nend"
    assert files.extracted("x.pdf", pdf((b"", b"no text"))) == ("", "error") and files.extracted("x.pdf", b"junk") == ("", "error")


def test_steps(spark, tmp_path):
    from quarrymill.plans import steps

    assert steps.reachable([1, 5, 99]) == {1: True, 5: True, 99: False}
    seen = []
    assert steps.run(spark, "/nowhere", [99, 1], lambda n, df: seen.append(n)) == {99: False} and not seen


def test_chat_lines_name_what_is_wrong(spark, tmp_path):
    lines = ['{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}', "{bad", '{"a": 1}', "3",
             '{"messages": [{"role": "user", "content": "q"}]}', " "]
    (tmp_path / "c.jsonl").write_text("\n".join(lines))
    path = str(tmp_path / "c.jsonl")
    found = {x.line: x.reason for x in files.chat_lines(spark, path).collect()}
    assert found == {lines[0]: None, lines[1]: "not_json", lines[2]: "wrong_shape", lines[3]: "wrong_shape", lines[4]: "short"}
    assert files.qa_from_chats(spark, path).count() == 1
    with pytest.raises(Exception, match="not_json"):
        files.qa_from_chats(spark, path, strict=True).collect()
    shapes = files.chat_lines(spark, path).select(G.structure_failed(F.col("messages")).alias("f")).collect()
    assert [x.f for x in shapes].count(False) == 1


def test_layouts_and_priorities(spark, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "none.json").write_text('{"other": []}')
    assert files.any_layout(spark, f"{folder}/none.json").count() == 0
    with pytest.raises(Exception, match="neither"):
        files.any_layout(spark, f"{folder}/none.json", required=True).collect()
    assert files.best_dataset(spark, folder, "set_en", "set.json") is None
    chat = '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}\n'
    (tmp_path / "set.jsonl").write_text(chat)
    best = lambda augmented=True: [x.instruction for x in files.best_dataset(spark, folder, "set_en", "set.json", augmented, "set.jsonl").collect()]
    assert best() == ["q"]
    (tmp_path / "set.json").write_text('{"dataset": [{"instruction": "plain"}], "qa_pairs": [{"instruction": "no"}]}')
    (tmp_path / "set_en_augmented_detailed.json").write_text('{"dataset": [{"instruction": "aug"}]}')
    assert best() == ["aug"] and best(False) == ["plain"]
    (tmp_path / "en.jsonl").write_text(chat)
    paths = {"en": f"{folder}/en.jsonl", "fr": f"{folder}/fr.jsonl"}
    assert files.to_publish(spark, paths, lambda x: None) == {"en": None, "fr": None}
    (tmp_path / "fr.jsonl").write_text(chat)
    assert {k: v.count() for k, v in files.to_publish(spark, paths, lambda x: None).items()} == {"en": 1, "fr": 1}


def test_documents_are_written_whole(spark, tmp_path):
    import json

    qa = spark.createDataFrame([(i, f"q{i}", None if i % 2 else "é\n\"") for i in range(9)], "idx bigint, instruction string, response string")
    meta = spark.createDataFrame([(9, None)], "total bigint, note string")
    sinks.write_document(str(tmp_path / "d"), "idx", meta, english_dataset=qa.repartition(3), french_dataset=qa.limit(0))
    (part,) = (tmp_path / "d").glob("part-*")
    found = json.loads(part.read_text())
    assert found["metadata"] == {"total": 9, "note": None} and found["french_dataset"] == []
    assert [x["idx"] for x in found["english_dataset"]] == list(range(9)) and found["english_dataset"][0]["response"] == 'é\n"'
    sinks.write_overlaid(qa, str(tmp_path / "o"), {"format": "x", "language": "none"}, language="fr")
    (part,) = (tmp_path / "o").glob("part-*")
    assert json.loads(part.read_text())["metadata"] == {"format": "x", "language": "fr", "total_pairs": "9"}
    out = str(tmp_path / "log")
    assert sinks.write_chats(qa, out) == 9 and sinks.write_chats(qa.limit(2), out, "append") == 2
    assert sinks.manifest(spark, out, str(tmp_path / "absent")).agg(F.sum("lines")).first()[0] == 11
    assert [x.purpose for x in sinks.recommendations(spark, {"eng": out, "fr": str(tmp_path / "absent")}).collect()] == ["for_english_only"]


def test_backing_off_and_augmentation(spark):
    pauses, calls = [], []

    def call(prompt):
        calls.append(prompt)
        return None if len(calls) < 3 else " done "

    assert generate.backing_off(call, sleep=pauses.append)("p", 0) == "done" and pauses == [2.0, 3.0]
    assert generate.backing_off(lambda p: 1 / 0, sleep=pauses.append)("p", 0) == "" and len(pauses) == 4
    answer = " ".join(f"word{i} is told." for i in range(60))
    qa = spark.createDataFrame([(i, f"What is thing {i} about?", answer) for i in range(4)], "idx bigint, instruction string, response string")

    def generator(prompt, attempt):
        if "Put this question" in prompt:
            return "" if attempt == 0 else "Question: How would you describe that thing then?"
        return "short" if "Put this answer" in prompt else "What happens in a team today?\n" + "It depends on many things. " * 20

    accepted, judged = generate.augmented(qa, generator)
    assert {(x.idx, x.augmentation_type, x.attempt) for x in accepted.collect()} == {
        (i, "contextual_variation", 0) for i in range(4)}
    counts = {(x.augmentation_type, x.reason): x["count"] for x in judged.groupBy("augmentation_type", "reason").count().collect()}
    # the gate rejects what keeps its answer, so that no paraphrase of a question passes
    assert counts == {("professional_paraphrase", "generation_failed"): 4, ("professional_paraphrase", "identical_response"): 8,
                      ("expert_reformulation", "generation_failed"): 12, ("contextual_variation", "ok"): 4}
    made = judged.where("augmentation_type = 'expert_reformulation'")
    assert profile.rejections(made).first().rejected == 12
    assert [x.reason for x in profile.top_reasons(judged.withColumn("reason", F.concat("reason", F.lit("_0.98")))).collect()] == ["generation_failed", "identical_response", "ok"]


def test_samples_of_few_rows(spark):
    rows = spark.range(3).withColumnRenamed("id", "idx")
    assert profile.row_at(rows, 5, "idx").first().idx == 2 and profile.row_at(rows.limit(0), 5, "idx").count() == 0
    assert profile.fields_present(rows, "idx", "none").collect()[1].present is False
    ragged = spark.createDataFrame([(0, [1.0, 0.0]), (1, None), (2, [1.0]), (3, [None, 1.0]), (4, [1.0, 1.0]), (5, [2.0, 0.0])], "id bigint, v array<double>")
    found = [(x.query, x.id) for x in search.cosine_topk(ragged, ragged, 1).orderBy("query").collect()]
    assert found == [(0, 5), (4, 0), (5, 0)]


def test_resume_takes_new_files_only(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    run = lambda: resume.resume(spark, source, "idx bigint", target, mark, lambda b: b.selectExpr("idx", "idx * 2 as twice"))
    spark.range(3).selectExpr("id as idx").write.json(source)
    run()
    spark.range(3, 5).selectExpr("id as idx").write.mode("append").json(source)
    run()
    assert sorted(x.idx for x in spark.read.parquet(f"{target}/*").collect()) == [0, 1, 2, 3, 4]
    rows, done = spark.createDataFrame([(1,), (2,), (None,)], "idx bigint"), spark.createDataFrame([(1,), (None,)], "idx bigint")
    assert {x.idx for x in resume.pending(rows, done, "idx").collect()} == {2, None}


def test_generation(spark):
    chunks = spark.createDataFrame([(1, "d", "alpha beta gamma delta " * 20)], "chunk_id bigint, document string, text string")
    assert generate.prompts(chunks).count() == 4
    assert generate.qa_from_chunks(chunks).count() == 4
    assert generate.generated(generate.prompts(chunks), lambda p, i: "" if i < 2 else "x").where("output = 'x'").count() == 4
    rows = generate.translated(spark.createDataFrame([("abc",)], "t string"), lambda t: 1 / 0, "t").collect()
    assert (rows[0].t_translated, rows[0].status) == ("abc", "failed")


def test_premium_keeps_one_of_near_copies(spark):
    answer = " ".join(f"Point {w} shows {w}y risk for {w}ing teams." for w in "alpha beta gamma delta epsilon zeta eta theta".split())
    qs = ["What is the risk of this work today?", "What is the risk of this work today!", "How does the team plan for every risk now?"]
    rows = [(i, q, answer, "en") for i, q in enumerate(qs)] + [(9, "Le projet est il un risque pour nous?", answer, "fr")]
    rows += [(10, "what is it", answer, "en"), (11, "Why is there a risk in it?", "No.", "en")]
    qa = spark.createDataFrame(rows, "idx bigint, instruction string, response string, language string")
    words = {"en": ("risk", "team"), "fr": ("risque", "projet", "risk")}
    found = premium.judged(premium.cleaned(qa), words).collect()
    assert {x.idx: x.reason for x in found} == {0: None, 1: None, 2: None, 9: None, 10: "question_length", 11: "answer_length"}
    assert sorted(x.idx for x in premium.premium(qa, words).collect()) == [0, 9]


def test_text_expressions_do_not_double(spark):
    """Words are split, not matched one by one; a text is named once for each prefix that is taken off."""
    row = spark.range(1).select(F.lit("x").alias("t"))
    plan = lambda c: row.select(c)._jdf.queryExecution().analyzed().toString()
    assert plan(T.clean_generated_question(F.col("t"))).count("startswith") == len(T.QUESTION_PREFIXES)
    for f in (T.word_count, T.words, T.word_set):
        assert "regexp_extract_all" not in plan(f(F.col("t"))) and "regexp_count" not in plan(f(F.col("t")))
    assert "composed" not in plan(T.compose(F.col("t"))) and one(spark, None, T.compose) is None
    assert one(spark, "é​ 가", T.compose) == "é 가"
    rows = ["", " ", "a", " a\x1cb \x85", None, "a​b c"]
    df = spark.createDataFrame([(t,) for t in rows], "t string").select("t", T.word_count(F.col("t")).alias("n"), T.words(F.col("t")).alias("w"), T.strip(F.col("t")).alias("s"))
    for r in df.collect():
        assert (r.n, r.w, r.s) == ((None, None, None) if r.t is None else (len(r.t.split()), r.t.split(), r.t.strip()))


def test_statistics_count_texts_before_rows_are_multiplied(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(merge, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    rows = [("en", "c", None, "one two", "a. b"), (None, "c", None, "one", None), ("fr", None, None, "q", "x y z.")]
    qa = spark.createDataFrame(rows, "language string, category string, difficulty string, instruction string, response string")
    found = {(x.section, x.key): x.value for x in merge.comprehensive_stats(qa, english=qa.where("language = 'en'")).collect()}
    assert plans[0].index("Generate") < plans[0].rindex("Aggregate") < plans[0].index("split(")
    assert found["total", "pairs"] == 3 and found["languages", "unknown"] == 1 and found["categories", "unknown"] == 1
    assert found["length_fr", "avg_response_sentences"] == 1 and found["length_unknown", "avg_response_sentences"] is None
    assert not any(s == "difficulties" for s, _ in found)


def test_cleaning_is_one_pass(spark, monkeypatch):
    """Cleaned texts are not kept on the way to reason and score, and are computed once."""
    from quarrymill.plans import queries

    kept = []
    monkeypatch.setattr(premium, "checkpointed", lambda df: kept.append(df.columns) or df)
    qa = spark.createDataFrame([(0, "What is the risk?", "A risk.", "en")], "idx bigint, instruction string, response string, language string")
    premium.premium(qa, {"en": ("risk",)})
    assert kept[0] == ["idx", "language", "q", "a", "score"]
    monkeypatch.setattr(queries.A, "doc_qa", lambda spark, d: qa)
    plan = queries.QUERIES["quality_score"](spark, "")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reflect(") == 2


def test_chunks_are_folded_once(spark, monkeypatch):
    """Ranges are found over documents; the fold comes after, so that no pass of sampling repeats it."""
    from quarrymill.operators import order

    plans = []
    keep = order.checkpointed
    monkeypatch.setattr(order, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df))
    docs = spark.createDataFrame([(i, "ab\n\ncd\n\nef") for i in (3, 1, 2, 1)], "doc_id bigint, text string")
    found = chunk.chunk_documents(docs, 4, 1).collect()
    assert plans[0].index("aggregate(") < plans[0].index("RepartitionByExpression")
    rows = sorted((x.chunk_id, x.doc_id, x.chunk_index) for x in found)
    assert rows == [(i * 2 + k, d, k) for i, d in enumerate((1, 1, 2, 3)) for k in (1, 2)]


def test_recommendations_combine_before_they_count_kinds(spark):
    qa = spark.createDataFrame([("What is it?", "w " * 10, "a"), ("How?", None, None)], "instruction string, response string, source string")
    plan = profile.recommendations(qa)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate") < plan.index("split(")
    assert {x.advice for x in profile.recommendations(qa).collect()} == {"short_responses", "many_low_quality", "few_question_types", "size_modest"}
    assert {x.advice for x in profile.recommendations(qa.where("response is null")).collect()} == {"few_question_types", "size_modest"}
    assert profile.recommendations(qa.limit(0)).count() == 0


def test_near_pairs_lose_none(spark):
    """Pairs at the threshold and over class bounds, against all pairs; candidates are bounded by parts, not by words."""
    r = random.Random(9)
    rows = []
    for n in (1, 2, 6, 7, 13, 20, 34, 41, 100, 117, 118, 230):
        base = [f"{n}w{k}" for k in range(n)]
        for cut in (0, n * 15 // 100, n * 15 // 100 + 1):
            rows.append(base[cut:])
        for _ in range(6):
            change = r.randint(0, max(1, n * 16 // 185))
            rows.append([*base[change:], *(f"x{r.randrange(10**6)}" for _ in range(change))])
    sets = {}
    for i, w in enumerate(rows):
        if w:
            sets.setdefault(frozenset(w), i)
    want = {(i, j): len(a & b) / len(a | b) for a, i in sets.items() for b, j in sets.items() if i < j and 100 * len(a & b) >= 85 * len(a | b)}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "idx bigint, text string").repartition(3)
    reps = dedup.representatives(docs, dedup.set_classes(docs))
    assert len(want) > 50 and {(x.a, x.b): x.jaccard for x in dedup.near_pairs(reps).collect()} == want
    assert dict(reps.dtypes)["tokens"] == "array<bigint>"
    common = spark.createDataFrame([(i, " ".join(f"c{k}" for k in range(40) if (i >> k % 8) & 1)) for i in range(1, 250)], "idx bigint, text string")
    signs = dedup.signed(dedup.representatives(common, dedup.set_classes(common)), 85)
    assert signs.groupBy("sign").count().where("count > 1").count() < signs.count() / 4


def test_documents_in_pieces(spark, tmp_path):
    """Many tasks write and read the document; put together by name the pieces are the document."""
    import json

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        qa = spark.createDataFrame([(i * 3, f"q{i}", None if i % 2 else 'é\n\r", {]') for i in range(99)], "idx bigint, instruction string, response string")
        path = str(tmp_path / "d")
        sinks.write_document(path, "idx", spark.createDataFrame([(9,)], "total bigint"), pieces=True, first=qa.limit(0), dataset=qa.repartition(3))
        parts = sorted((tmp_path / "d").glob("part-*"))
        whole = json.loads("".join(p.read_text() for p in parts))
        assert len(parts) > 1 and whole["first"] == [] and whole["metadata"] == {"total": 9}
        found = files.in_pieces(spark, path, "none", "dataset")
        assert found.rdd.getNumPartitions() > len(parts)
        rows = sorted(found.collect())
        assert [(x.idx, x.instruction, x.response) for x in rows] == [(i, r["instruction"], r["response"]) for i, r in enumerate(whole["dataset"])]
        assert len(rows) == 99 and files.in_pieces(spark, path, "none").count() == files.in_pieces(spark, path, "first").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_heavy_text_steps_have_plain_plans(spark):
    """Cleaning and free text run without Python and without matching word by word; what is blank at the ends is trimmed."""
    from quarrymill.plans import premium as M

    qa = spark.createDataFrame([(0, "Is « it » ?", "é " * 3, "en", "a")], "idx bigint, instruction string, response string, language string, text string")
    plans = [M.cleaned(qa), M.judged(M.cleaned(qa), G.KEYWORDS), qa.select(T.split_question_answer(F.col("text"))), qa.select(T.clean_document(F.col("text")))]
    for plan in (p._jdf.queryExecution().optimizedPlan().toString() for p in plans):
        assert "Python" not in plan and "regexp_extract_all" not in plan and f"^{T.WS}+|" not in plan
    assert M.cleaned(qa).first().a == "É é é."
    assert one(spark, "a bĀé　c​", T.clean_document) == "a bé　c"


# Blanks of several kinds, marks and what stands between them.
ODD = (" ", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", " ", "　", ".", ",", "!", "?", ";", ":", "..", "a", "B", "é", "«", "😀")


def odd_texts(n: int) -> list[str]:
    pick = random.Random(5)
    return ["", " ", ".", " . ", "\n", *("".join(pick.choice(ODD) for _ in range(pick.randrange(1, 25))) for _ in range(n))]


def plan_of(spark, f) -> str:
    return spark.createDataFrame([("",)], "t string").select(f(F.col("t")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()


def test_marks_are_tidied_in_one_match_as_by_their_rules(spark):
    """score_summary, default_vocabulary_reasons, clean_text_en: the ten rules, one after the other, and how many patterns run."""

    def by_rules(t: str) -> str:
        for p, by in ((r"\t", " "), (" {2,}", " "), (r"\s+([.,!?;:])", r"\1"), (r"([.,!?;:])(?=\S)", r"\1 ")):
            t = re.sub(p, by, t)
        t = t.strip()
        for p, by in ((r"\.{2,}", "."), (r"\?{2,}", "?"), ("!{2,}", "!"), (",{2,}", ","), (r"\s+([.,])", r"\1"), (r"([^.!?])\Z", r"\1."), (r"([.!?,;:])\s+", r"\1 ")):
            t = re.sub(p, by, t)
        return t

    df = spark.createDataFrame([(t,) for t in odd_texts(1500)], "t string").select("t", T.tidy_marks(F.col("t")).alias("n"))
    assert [r for r in df.collect() if r.n != by_rules(r.t)] == []
    plan = plan_of(spark, lambda c: T.clean_text(c, "en"))
    assert T.WS not in plan and T.NOT_WS not in plan and "translate(" not in plan
    assert plan.count("regexp_replace(") == 4 + len(T.TERMS)  # links, addresses, runs of blanks, marks; all but one where needed


def test_judging_looks_for_parts_before_it_matches(spark):
    """score_summary: no pattern runs over a whole text for its end or a placeholder, and sequences are hashed."""
    plan = plan_of(spark, lambda c: G.quality_score(c, c, {"en": ("the",)}, F.lit("en")))
    assert "xxhash64" in plan and T.WS not in plan and "[.!?]\\z" not in plan and "XXX+" not in plan
    for t, found in (("a [b] c", True), ("a ]b[", False), ("{\n}", False), ("< >", True), ("toDo", True), ("xXx", True), ("xx", False), ("a...", True), ("", False)):
        assert one(spark, t, T.has_placeholder) is found
    assert one(spark, "a b c " * 3 + "d", T.is_repetitive) and not one(spark, "a b c " * 2 + "d e f g", T.is_repetitive)
    assert one(spark, "so?", T.ends_sentence) and not one(spark, "so? ", T.ends_sentence) and not one(spark, "", T.ends_sentence)


def test_documents_are_matched_only_where_they_must(spark):
    """doc_clean_filter: runs of lines and characters above Latin-1 are looked for first; words end at a short class of blanks."""
    plan = plan_of(spark, lambda c: T.word_count(T.clean_document(c)))
    assert "octet_length" in plan and "contains" in plan.lower() and T.WS not in plan and T.NOT_WS not in plan

    def by_rules(t: str) -> str:
        return "".join(x for x in re.sub("\n{3,}", "\n\n", t) if x <= "\xff" or x.isspace()).strip()

    rows = [t + "\n" * k + t for k, t in enumerate(odd_texts(300))]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    df = df.select("t", T.clean_document(F.col("t")).alias("c"), T.word_count(F.col("t")).alias("n"))
    assert [r for r in df.collect() if r.c != by_rules(r.t) or r.n != len(r.t.split())] == []


def test_quotes_at_the_ends_are_trimmed_without_a_pattern(spark):
    """free_text_qa_split, augment_pairs."""
    plan = plan_of(spark, T.split_question_answer)
    assert "regexp_replace" not in plan and T.WS not in plan
    text = "\"'What is it, then?'\"\n" + "\"" + "it is so " * 20 + "'\"'"
    found = one(spark, text, T.split_question_answer)
    assert found.instruction == "What is it, then?" and found.response == ("it is so " * 20).strip()


def test_answers_are_cut_into_words_once_for_their_score(spark):
    """score_summary: one split for the number of words and what repeats, whose hashes are sorted only if two are left over."""
    plan = plan_of(spark, lambda c: G.quality_score(F.lit("what is it"), c, {"en": ("the",)}, F.lit("en")))
    assert plan.count("split(") == 2 and "array_distinct(" in plan  # words and sentences
    pick = random.Random(9)
    texts = ["", "a", "a b c " * 3, "a " * 12, "a " * 9, "x y " + "a b " * 4 + "z", *(" ".join(pick.choice("abcd") for _ in range(pick.randrange(8, 60))) for _ in range(400))]

    def repeats(t: str) -> bool:
        w = t.split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        return len(w) >= 10 and max(map(grams.count, grams)) > 2

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.is_repetitive(F.col("t")).alias("r")).collect()
    assert [r for r in rows if r.r is not repeats(r.t)] == [] and {r.r for r in rows} == {True, False}


def test_texts_are_put_into_lower_case_once_and_searched_before_they_change(spark):
    """score_summary: one lower case for keywords and placeholders of both texts, sentences cut no further than the second
    one, ends looked at from the end, and plain replacements only where there is something to replace."""
    plan = plan_of(spark, lambda c: G.quality_score(c, c, {"en": ("the",)}, F.lit("en")))
    assert plan.count("lower(") == 1 and "*+, 3)" in plan and "substring(" not in plan
    plan = plan_of(spark, T.tidy_marks)
    assert plan.count("replace(") == 2 + 1 and plan.lower().count("contains(") == 2  # two patterns and tabs; tabs and two blanks
    texts = [*odd_texts(1500), "a. b", "?!a", "?!a. ", "a.\u3000.", "a.\u3000b", "a" * 9]
    cut = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.has_sentences(F.col("t")).alias("n")).collect()
    assert [r for r in cut if r.n is not (len([x for x in re.split("[.!?]+", r.t) if x.strip()]) > 1)] == []
    rest = " is it. " + " ".join(f"w{i}" for i in range(30)) + "."
    rows = [("what is it to us", "the" + rest, 10.0), ("what is the toDo of", "the" + rest, 7.0), ("what is it to us", "the xXx" + rest, 7.0),
            ("what is xx", "x" + rest, 6.0), ("what [is it", "to] us" + rest, 6.0), (None, "todo" + rest, 7.0), ("what is it to us", None, 10.0)]
    rows = [*((*r, "en") for r in rows), (None, "the" + rest, 8.0, "de")]
    df = spark.createDataFrame(rows, "q string, a string, n double, l string")
    scored = df.select("n", G.quality_score(F.col("q"), F.col("a"), {"en": ("the", "is")}, F.col("l")).alias("s")).collect()
    assert [r.s for r in scored] == [r.n for r in scored]
