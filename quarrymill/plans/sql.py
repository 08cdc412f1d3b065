"""The queries in DuckDB's SQL."""

from __future__ import annotations

from quarrymill.functions import text as T
from quarrymill.operators import profile as P

WS, NWS, NW = T.WS, T.NOT_WS, T.NOT_WORD


def lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def rx(t: str, *pairs: tuple[str, str]) -> str:
    for p, by in pairs:
        t = f"regexp_replace({t}, {lit(p)}, {lit(by)}, 'g')"
    return t


def strip(t: str) -> str:
    return rx(t, (f"^{WS}+|{WS}+\\z", ""))


def words(t: str) -> str:
    return f"regexp_extract_all({t}, {lit(NWS + '+')})"


def wc(t: str) -> str:
    return f"len({words(t)})"


def periods(t: str) -> str:
    return f"(length({t}) - length(replace({t}, '.', '')))"


def present(t: str, phrases) -> str:
    return "(" + " + ".join(f"CAST(contains({t}, {lit(p)}) AS BIGINT)" for p in phrases) + ")"


def sents(t: str) -> str:
    return f"list_transform(string_split_regex({t}, '[.!?]+'), lambda s: {strip('s')})"


def first(*rules: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {lit(n)}" for n, c in rules) + " END"


DOC_QA = """doc_qa AS (SELECT doc_id AS idx, split_part(text, chr(10), 1) AS instruction,
  CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS response, source,
  'topic' || (doc_id % 4) AS category, 'level' || (doc_id % 3) AS difficulty, lang AS language FROM documents)"""
CONV_QA = """conv_qa AS (SELECT u.conv_id, u.turn, u.text AS instruction, a.text AS response FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant')"""
VARIATIONS = CONV_QA + """, v AS (SELECT * FROM (SELECT conv_id, turn, instruction AS original_q, response AS original_a,
  lead(instruction) OVER w AS q, lead(response) OVER w AS a FROM conv_qa WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE q IS NOT NULL)"""


def detect() -> str:
    head = "lower(substr(text, 1, 800))"
    fr, en = (present("h", [f" {w} " for w in ws]) for ws in (T.FRENCH, T.ENGLISH))
    return f"""SELECT doc_id, CASE WHEN len(regexp_extract_all(h, '[\\x{{0600}}-\\x{{06FF}}]')) > 20 THEN 'arabic'
      WHEN {fr} > {en} + 2 THEN 'french' ELSE 'english' END AS detected FROM (SELECT doc_id, {head} AS h FROM documents)"""


def document(t: str) -> str:
    return strip(rx(t, ("\\n{3,}", "\n\n"), (f"[^\\x{{0}}-\\x{{ff}}{T.SPACES}]", "")))


CHUNKS = f"""WITH RECURSIVE p AS (SELECT doc_id, string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)) AS ps FROM documents),
f AS (SELECT doc_id, ps, 0 AS i, CAST([] AS VARCHAR[]) AS done, '' AS cur FROM p
  UNION ALL
  SELECT doc_id, ps, i + 1,
    CASE WHEN length(cur) + length(ps[i + 1]) > 2500 AND cur <> '' THEN list_append(done, {strip('cur')}) ELSE done END,
    CASE WHEN length(cur) + length(ps[i + 1]) > 2500 AND cur <> ''
      THEN (CASE WHEN length(cur) > 300 THEN right(cur, 300) ELSE cur END) || chr(10) || chr(10) || ps[i + 1]
      WHEN cur <> '' THEN cur || chr(10) || chr(10) || ps[i + 1] ELSE ps[i + 1] END
  FROM f WHERE i < len(ps)),
c AS (SELECT doc_id, CASE WHEN cur <> '' THEN list_append(done, {strip('cur')}) ELSE done END AS cs FROM f WHERE i = len(ps)),
n AS (SELECT doc_id, cs, len(cs) AS total_chunks, coalesce(sum(len(cs)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM c),
chunks AS (SELECT doc_id, CAST(b + k AS BIGINT) AS chunk_id, CAST(k AS BIGINT) AS chunk_index, CAST(total_chunks AS BIGINT) AS total_chunks,
  cs[k] AS text, CAST({wc('cs[k]')} AS BIGINT) AS word_count FROM (SELECT *, unnest(range(1, len(cs) + 1)) AS k FROM n))"""


def generation(q: str, a: str) -> str:
    low = f"lower({a})"
    return f"""length({q}) >= 20 AND length({a}) >= 150 AND {wc(a)} >= 50 AND {periods(a)} >= 5
      AND {present(low, T.GENERIC)} <= 3 AND len(list_filter({words(a)}, lambda w: length(w) > 4)) >= 25"""


FINAL = f"instruction <> '' AND response <> '' AND length(instruction) >= 15 AND length(response) >= 80 AND {wc('response')} >= 30 AND {periods('response')} >= 3"


def short_key(t: str) -> str:
    return f"substr({rx(f'lower({t})', (NW + '+', ''))}, 1, 70)"


def normalized(t: str) -> str:
    return strip(rx(f"lower({t})", (f"[^\\p{{L}}\\p{{N}}_{T.SPACES}]", ""), (f"{WS}+", " ")))


def best(source: str, keys: str) -> str:
    return f"""best AS (SELECT *, min(idx) OVER (PARTITION BY {keys}) AS first_idx,
      row_number() OVER (PARTITION BY {keys} ORDER BY length(response) DESC, idx) AS rn FROM {source})"""


def clean(t: str, language: str) -> str:
    mail = "\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Z|a-z]{2,}\\b"
    t = f"replace(replace(nfc_normalize(coalesce({t}, '')), chr(8203), ''), chr(65279), '')"
    t = rx(t, (f"https?://{NWS}+|www\\.{NWS}+", ""), (mail, ""))
    t = rx(f"replace({t}, chr(9), ' ')", (" +", " "), (f"{WS}+([.,!?;:])", "\\1"), *[(f"([.,!?;:])({NWS})", "\\1 \\2")] * 2)
    t = rx(strip(t), ("\\.{2,}", "."), ("\\?{2,}", "?"), ("!{2,}", "!"), (",{2,}", ","), (f"{WS}+([.,])", "\\1"))
    return t


def cleaned(source: str, language: str, columns: dict[str, str]) -> str:
    """A chain of CTEs' bodies: each step names its input once."""
    steps = f"SELECT * REPLACE ({', '.join(f'{clean(c, language)} AS {c}' for c in columns)}) FROM {source}"
    steps = f"SELECT * REPLACE ({', '.join(f'''CASE WHEN regexp_matches({c}, '[^.!?]\\z') THEN {c} || '.' ELSE {c} END AS {c}''' for c in columns)}) FROM ({steps})"
    steps = f"SELECT * REPLACE ({', '.join(rx(c, (f'([.!?,;:]){WS}+', chr(92) + '1 ')) + f' AS {c}' for c in columns)}) FROM ({steps})"
    steps = f"SELECT * REPLACE ({', '.join(f'''CASE WHEN regexp_matches(left({c}, 1), '\\p{{Ll}}') THEN upper(left({c}, 1)) || substr({c}, 2) ELSE {c} END AS {c}''' for c in columns)}) FROM ({steps})"
    last = {c: rx(c, *((f"(?i)\\b{a}\\b", b) for a, b in T.TERMS)) for c in columns}
    if language == "fr":
        last = {c: f"replace({rx(t, (f'«{WS}*', '« '), (f'{WS}*»', ' »'))}, {lit(chr(39) + ' ')}, {lit(chr(39))})" for c, t in last.items()}
    return f"SELECT * REPLACE ({', '.join(f'{strip(t)} AS {c}' for c, t in last.items())}) FROM ({steps})"


def placeholder(t: str) -> str:
    return f"regexp_matches({t}, '(?i)\\[[^\\n]*?\\]|\\{{[^\\n]*?\\}}|XXX+|TODO|\\.\\.\\.|<[^\\n]*?>')"


def repetitive(t: str) -> str:
    w = words(t)
    grams = f"list_transform(list_zip({w}, {w}[2:], {w}[3:]), lambda x: x[1] || ' ' || x[2] || ' ' || x[3])"
    return f"(len({w}) >= 10 AND list_aggregate(map_values(list_aggregate({grams}, 'histogram')), 'max') > 2)"


def echo(t: str) -> str:
    w = words(f"lower({t})")
    return f"len(list_filter(list_zip({w}, {w}[2:]), lambda x: x[1] = x[2] AND length(x[1]) > 3)) > 0"


def bad_start(t: str) -> str:
    return f"len(list_filter({sents(t)}, lambda s: s <> '' AND NOT regexp_matches(s, '^\\p{{Lu}}'))) > 0"


def low_info(t: str) -> str:
    low = strip(f"lower({t})")
    return f"""(regexp_matches({low}, '^(?:(?:yes|no|maybe|it depends|oui|non|peut-être|ça dépend)\\.?|[^\\n]{{1,30}})\\n?\\z')
      OR regexp_matches({low}, '^(?:i don''t know|je ne sais pas)'))"""


def reason(keywords) -> str:
    subject = " OR ".join(f"contains(lower(q || ' ' || a), {lit(k)})" for k in keywords)
    return first(
        ("question_length", "NOT length(q) BETWEEN 15 AND 800"), ("answer_length", "NOT length(a) BETWEEN 50 AND 2500"),
        ("question_words", f"NOT {wc('q')} BETWEEN 5 AND 150"), ("answer_words", f"NOT {wc('a')} BETWEEN 20 AND 500"),
        ("incomplete", "NOT regexp_matches(a, '[.!?]\\z')"), ("low_info", low_info("a")),
        ("structure_bad", f"len(list_filter({sents('a')}, lambda s: length(s) > 10)) < 2"),
        ("grammar", f"({echo('q')} OR {bad_start('q')})"), ("off_subject", f"NOT ({subject})"),
        ("placeholders", f"({placeholder('q')} OR {placeholder('a')})"), ("repetitive", repetitive("a")),
    )


def score(keywords) -> str:
    low = "lower(q || ' ' || a)"
    rules = (
        (f"{wc('q')} < 5", 2.0), (f"{wc('a')} < 20", 2.0), (f"{wc('a')} > 500", 1.0),
        (f"len(list_filter({sents('a')}, lambda s: s <> '')) < 2", 1.5), (f"{present(low, keywords)} < 2", 2.0),
        (f"{placeholder('q')} OR {placeholder('a')}", 3.0), (repetitive("a"), 2.0), (f"NOT regexp_matches({strip('a')}, '[.!?]\\z')", 1.0),
    )
    taken = " - ".join(f"CASE WHEN {c} THEN CAST({v} AS DOUBLE) ELSE 0 END" for c, v in rules)
    return f"greatest(CAST(0 AS DOUBLE), CAST(10 AS DOUBLE) - {taken})"


def clean_languages(*languages: str) -> str:
    columns = {"q": "", "a": ""}
    parts = []
    for language in languages:
        source = f"(SELECT idx, language, instruction AS q, response AS a FROM doc_qa WHERE language = '{language}')"
        parts.append(cleaned(source, language, columns))
    return "cl AS MATERIALIZED (" + " UNION ALL ".join(f"({p})" for p in parts) + ")"


def judged(vocabularies) -> str:
    parts = [f"SELECT *, {reason(k)} AS reason, {score(k)} AS score FROM cl WHERE language = '{n}'" for n, k in vocabularies.items()]
    return "jd AS MATERIALIZED (" + " UNION ALL ".join(parts) + ")"


def near(source: str, text: str = "text", by: str | None = None) -> str:
    """ns: idx, tokens, rep of word sets; np: pairs of representatives."""
    group = f"{by}, " if by else ""
    same = f"AND x.{by} = y.{by} " if by else ""
    return f"""ns AS MATERIALIZED (SELECT *, min(idx) OVER (PARTITION BY {group}tokens) AS rep FROM (
      SELECT idx, {group}list_sort(list_distinct({words(f'lower({text})')})) AS tokens FROM {source}) WHERE len(tokens) > 0),
    np AS MATERIALIZED (SELECT a, b, i / u AS jaccard FROM (SELECT x.idx AS a, y.idx AS b, len(list_intersect(x.tokens, y.tokens)) AS i,
      len(x.tokens) + len(y.tokens) - len(list_intersect(x.tokens, y.tokens)) AS u FROM ns x JOIN ns y ON x.idx < y.idx {same}
      AND 100 * len(x.tokens) >= 85 * len(y.tokens) AND 100 * len(y.tokens) >= 85 * len(x.tokens)
      WHERE x.idx = x.rep AND y.idx = y.rep) WHERE 100 * i >= 85 * u)"""


GREEDY = """nd AS MATERIALIZED (SELECT a AS id, row_number() OVER (ORDER BY a) AS k, list(b) AS nb FROM np GROUP BY a),
gr AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS gone UNION ALL
  SELECT nd.k, CASE WHEN list_contains(gone, nd.id) THEN gone ELSE list_concat(gone, nd.nb) END FROM gr JOIN nd ON nd.k = gr.k + 1),
out AS MATERIALIZED (SELECT DISTINCT unnest(gone) AS id FROM gr WHERE k = (SELECT max(k) FROM gr))"""


def bins(measure: str, bounds) -> str:
    rows = ", ".join(f"({a}, {b})" for a, b in bounds)
    return f"""WITH {DOC_QA}, v AS (SELECT {measure} AS v FROM doc_qa)
      SELECT CAST(low AS BIGINT) AS low, CAST(high AS BIGINT) AS high, count(v) FILTER (WHERE v >= low AND v < high) AS n,
      count(v) FILTER (WHERE v >= low AND v < high) * 100.0::DOUBLE / count(*) AS percent FROM (VALUES {rows}) b(low, high), v GROUP BY low, high"""


def question_type(q: str) -> str:
    low = f"lower({q})"
    whens = [f"WHEN starts_with({low}, '{w}') THEN '{w.capitalize()}'" for w in ("what", "how", "why", "when", "where")]
    whens += [f"WHEN contains(substr({low}, 1, 20), '{w}') THEN '{w.capitalize()}'" for w in ("define", "explain", "describe")]
    return "CASE " + " ".join(whens) + " ELSE 'Other' END"


def entities(t: str) -> str:
    capitals = f"list_filter(string_split_regex({t}, {lit(NW + '+')}), lambda w: regexp_matches(w, '^[A-Z]{{2,}}$'))"
    camel = f"regexp_extract_all({t}, '[A-Z][a-z]+(?:[A-Z][a-z]+)+')"
    return f"list_sort(list_distinct(list_transform(list_concat({capitals}, {camel}), lambda x: lower(x))))"


def wset(t: str) -> str:
    return f"list_distinct({words(f'lower({t})')})"


def variation() -> str:
    same = f"len(list_intersect({wset('original_q')}, {wset('q')})) / len({wset('original_q')})"
    rest = "replace(lower(a), lower(q), '')"
    starts = "|".join(T.QUESTION_WORDS)
    return first(
        ("instruction_too_short", f"{wc('q')} < 3"), ("response_too_short", f"{wc('a')} < 30"),
        ("not_a_question", f"NOT (contains(q, '?') OR regexp_matches(lower({strip('q')}), '^({starts})'))"),
        ("identical_response", f"{strip('a')} = {strip('original_a')}"),
        ("too_similar", f"len({wset('original_q')}) > 0 AND {same} > 0.98"),
        ("poor_quality_phrases", f"{present('lower(a)', T.WORN)} > 3"),
        ("malformed_response", "(length(a) - length(replace(a, chr(10) || chr(10) || chr(10), ''))) / 3 > 2"),
        ("response_repeats_question", f"contains(lower(a), lower(q)) AND {wc(rest)} < 20"),
    )


def free_text() -> str:
    asks = "length(x) > 15 AND (contains(x, '?') OR regexp_matches(lower(x), '^(how|what|when|why|where)'))"
    edges = ("^[\"']+|[\"']+\\z", "")

    def finish(t: str) -> str:
        t = strip(rx(t, edges))
        for p in T.FREE_PREFIXES:
            t = strip(f"replace({t}, {lit(p)}, '')")
        return t

    return f"""WITH l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: {strip('x')}) AS ls FROM documents WHERE length(text) > 30),
    q AS (SELECT doc_id, ls, list_filter(range(1, len(ls) + 1), lambda i: list_transform(ls, lambda x: {asks})[i])[1] AS qa FROM l),
    a AS (SELECT doc_id, ls, qa, CASE WHEN qa IS NOT NULL THEN list_filter(range(qa + 1, len(ls) + 1), lambda i: length(ls[i]) > 50)[1] END AS aa,
      coalesce(list_filter(ls[1:5], lambda x: length(x) > 15)[1], ls[qa]) AS spare FROM q),
    p AS (SELECT doc_id, CASE WHEN aa IS NOT NULL THEN ls[qa] ELSE spare END AS q,
      CASE WHEN aa IS NOT NULL THEN array_to_string(list_filter(ls[aa:], lambda x: x <> ''), ' ')
        ELSE coalesce(array_to_string(list_filter(ls, lambda x: x <> '' AND x <> spare), ' '), '') END AS a FROM a)
    SELECT doc_id, {finish('q')} AS instruction, {finish('a')} AS response FROM p WHERE q IS NOT NULL AND {wc('a')} >= 50"""


__all__ = ["P"]
