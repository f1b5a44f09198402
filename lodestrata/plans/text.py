"""Queries of the text functions and quality rules."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import rules as Q
from ..runtime import cut, skew_safe_lookup
from .base import Book

book = Book()
queries = lambda: book.queries
oracle_sql = lambda: book.sql

T = lambda: F.col("text")  # noqa: E731 - columns need a session


def sq(value: str) -> str:
    return value.replace("'", "''")


def _rr(expr: str, pattern: str, to: str = "") -> str:
    flags = ""
    if pattern.startswith("(?"):
        flags, pattern = pattern[2 : pattern.index(")")], pattern[pattern.index(")") + 1 :]
        flags = flags.replace("d", "")
    head = f"(?{flags})" if flags else ""
    return f"regexp_replace({expr}, '{sq(head + pattern)}', '{to}', 'g')"


WS = X.WS
STRIP = lambda e: _rr(e, f"^{WS}+|{WS}+$")
NORM = lambda e: STRIP(_rr(_rr(e, r"(?:[^\S\n]|[\p{Z}\x{1c}-\x{1f}\x{85}])+\n", "\n"), r"\n{3,}", "\n\n"))


def _boiler(e: str, patterns: list[str]) -> str:
    for p in patterns:
        e = _rr(e, p)
    return NORM(e)


WORDS = lambda e: f"list_filter(regexp_split_to_array({e}, '{WS}+'), lambda w: w <> '')"
NW = lambda e: f"len({WORDS(e)})"
COUNT = lambda e, p: f"len(regexp_extract_all({e}, '{sq(p)}'))"
STOPS = ", ".join(f"'{w}'" for w in X.STOP_WORDS)
CH = "(SELECT DISTINCT * FROM chunks)"
DOC = "(SELECT DISTINCT * FROM documents)"
PARSED = "(SELECT DISTINCT * FROM parsed_docs)"
ALPHA = f"length({_rr('text', r'\P{L}')}) / nullif(length({_rr('text', WS)}), 0)"
LINKS = f"coalesce({COUNT('text', X.LINK)} / nullif({NW('text')}, 0), 0.0)"
STOP = f"coalesce(len(list_filter({WORDS('lower(text)')}, lambda w: w IN ({STOPS}))) / nullif({NW('text')}, 0), 0.0)"
TERM = f"coalesce({COUNT('text', X.TERMINAL)} / nullif({NW('text')}, 0), 0.0)"
TOK = COUNT("text", X.TOKEN)


def r6(c: Column) -> Column:
    return F.round(c, 6)


@book.add(f"SELECT doc_id, length(c) AS cleaned_chars, sha256(c) AS cleaned_hash FROM (SELECT doc_id, {_boiler('text', X.BOILERPLATE)} AS c FROM {DOC} d WHERE text IS NOT NULL)", per_row=True)
def remove_boilerplate(t):
    c = X.remove_boilerplate(T())
    return t("documents").where(T().isNotNull()).select("doc_id", c.alias("c")).select("doc_id", F.char_length("c").cast("bigint").alias("cleaned_chars"), F.sha2("c", 256).alias("cleaned_hash"))


@book.add(f"SELECT parsed_id, length(c) AS cleaned_chars, sha256(c) AS cleaned_hash FROM (SELECT parsed_id, {_boiler('text', X.BOILERPLATE)} AS c FROM {PARSED} d WHERE text IS NOT NULL)", per_row=True)
def clean_parsed_text(t):
    return t("parsed_docs").where(T().isNotNull()).select("parsed_id", X.remove_boilerplate(T()).alias("c")).select("parsed_id", F.char_length("c").cast("bigint").alias("cleaned_chars"), F.sha2("c", 256).alias("cleaned_hash"))


@book.add(f"SELECT doc_id, sha256({NORM('text')}) AS h FROM {DOC} d WHERE text IS NOT NULL", per_row=True)
def normalize_ws(t):
    return t("documents").where(T().isNotNull()).select("doc_id", F.sha2(X.normalize_whitespace(T()), 256).alias("h"))


@book.add(f"SELECT chunk_id, {TOK} AS tokens, {TOK} >= 3 AS passed FROM {CH} c", per_row=True)
def pred_token_floor(t):
    return t("chunks").select("chunk_id", X.token_count(T()).alias("tokens"), (X.token_count(T()) >= 3).alias("passed"))


@book.add(f"SELECT chunk_id, round({ALPHA}, 6) AS ratio, coalesce({ALPHA} >= 0.5, false) AS passed FROM {CH} c", per_row=True)
def pred_alpha_ratio(t):
    return t("chunks").select("chunk_id", r6(X.alpha_ratio(T())).alias("ratio"), F.coalesce(X.alpha_ratio(T()) >= 0.5, F.lit(False)).alias("passed"))


@book.add(f"SELECT chunk_id, round({LINKS}, 6) AS density, {NW('text')} < 6 OR {LINKS} <= 0.3 AS passed FROM {CH} c", per_row=True)
def pred_link_density(t):
    return t("chunks").select("chunk_id", r6(X.link_density(T())).alias("density"), ((X.n_words(T()) < 6) | (X.link_density(T()) <= 0.3)).alias("passed"))


@book.add(f"SELECT chunk_id, round({STOP}, 6) AS ratio, {NW('text')} < 6 OR {STOP} >= 0.05 AS passed FROM {CH} c", per_row=True)
def pred_stopword_ratio(t):
    return t("chunks").select("chunk_id", r6(X.stopword_ratio(T())).alias("ratio"), ((X.n_words(T()) < 6) | (X.stopword_ratio(T()) >= 0.05)).alias("passed"))


@book.add(f"SELECT chunk_id, round({TERM}, 6) AS ratio, {NW('text')} < 6 OR {TERM} >= 0.02 AS passed FROM {CH} c", per_row=True)
def pred_terminal_punct(t):
    return t("chunks").select("chunk_id", r6(X.terminal_ratio(T())).alias("ratio"), ((X.n_words(T()) < 6) | (X.terminal_ratio(T()) >= 0.02)).alias("passed"))


@book.add(f"SELECT chunk_id, {TOK} AS token_count, round({LINKS}, 6) AS link_density, round({TERM}, 6) AS terminal_punct_ratio, round({STOP}, 6) AS stopword_ratio FROM {CH} c", per_row=True)
def substance_signals(t):
    return t("chunks").select("chunk_id", X.token_count(T()).alias("token_count"), r6(X.link_density(T())).alias("link_density"), r6(X.terminal_ratio(T())).alias("terminal_punct_ratio"), r6(X.stopword_ratio(T())).alias("stopword_ratio"))


_GATE = f"""CASE WHEN {TOK} < 3 THEN 'below_token_floor' WHEN {ALPHA} IS NULL THEN 'empty_text' WHEN {ALPHA} < 0.5 THEN 'below_alpha_ratio'
    WHEN {NW('text')} >= 6 AND {LINKS} > 0.3 THEN 'above_link_density' WHEN {NW('text')} >= 6 AND {STOP} < 0.05 THEN 'below_stopword_ratio'
    WHEN {NW('text')} >= 6 AND {TERM} < 0.02 THEN 'below_terminal_punct' ELSE 'all_checks_passed' END"""


@book.add(f"SELECT chunk_id, code AS reason_code, code = 'all_checks_passed' AS passed FROM (SELECT chunk_id, {_GATE} AS code FROM {CH} c)", per_row=True)
def substance_gate(t):
    rows = t("chunks").select("chunk_id", Q.once(Q.signals(T())).alias("s"))
    return rows.select("chunk_id", Q.code_of(F.col("s")).alias("reason_code")).withColumn("passed", F.col("reason_code") == "all_checks_passed")


_FW_LINES = f"list_filter(list_transform(string_split(text, chr(10)), lambda l: {STRIP('l')}), lambda l: l <> '')"
_FW = f"""CASE WHEN len(ls) = 0 THEN 'empty' WHEN len(list_filter(ls, lambda l: regexp_matches(l, '{X.TERMINAL}[''"”’)]*$'))) / len(ls) < 0.12 THEN 'line_punct_ratio'
    WHEN len(list_filter(ls, lambda l: length(l) <= 30)) / len(ls) > 0.67 THEN 'short_line_ratio'
    WHEN 1 - list_sum(list_transform(list_distinct(ls), lambda l: length(l))) / list_sum(list_transform(ls, lambda l: length(l))) > 0.01 THEN 'char_dup_ratio'
    WHEN {COUNT('text', chr(92) + 'n')} > 0.3 * {NW('text')} THEN 'list_ratio' ELSE 'passed' END"""


@book.add(f"SELECT chunk_id, {_FW} AS result FROM (SELECT chunk_id, text, {_FW_LINES} AS ls FROM {CH} c)", per_row=True)
def fineweb_quality(t):
    return t("chunks").select("chunk_id", Q.fineweb_code(T()).alias("result"))


@book.add(f"""SELECT chunk_id, CASE WHEN is_table THEN 'table_exempt' WHEN fw <> 'passed' THEN 'fineweb_' || fw ELSE code END AS reason_code,
    coalesce(is_table, false) OR (fw = 'passed' AND code = 'all_checks_passed') AS passed
    FROM (SELECT chunk_id, is_table, {_FW} AS fw, {_GATE} AS code FROM (SELECT chunk_id, is_table, text, {_FW_LINES} AS ls FROM {CH} c))""", per_row=True)
def chunk_gate(t):
    both = F.struct(Q.signals(T()).alias("s"), Q.fineweb_code(T()).alias("fw"))
    rows = t("chunks").select("chunk_id", "is_table", Q.once(both).alias("b")).select("chunk_id", "is_table", Q.code_of(F.col("b.s")).alias("code"), "b.fw")
    reason = F.when(F.col("is_table"), "table_exempt").when(F.col("fw") != "passed", F.concat(F.lit("fineweb_"), "fw")).otherwise(F.col("code"))
    return rows.select("chunk_id", reason.alias("reason_code"), (F.coalesce("is_table", F.lit(False)) | ((F.col("fw") == "passed") & (F.col("code") == "all_checks_passed"))).alias("passed"))


_GOPHER = f"""CASE WHEN len(ws) < 50 THEN 'short_doc' WHEN len(ws) > 100000 THEN 'long_doc'
    WHEN mean < 3 THEN 'below_avg_word_length' WHEN mean > 10 THEN 'above_avg_word_length'
    WHEN {COUNT('text', '#')} > 0.1 * len(ws) THEN 'too_many_hashes' WHEN {COUNT('text', '[.][.][.]|…')} > 0.1 * len(ws) THEN 'too_many_ellipsis'
    WHEN len(list_filter(ls, lambda l: regexp_matches(l, '^{WS}*[-•*]'))) > 0.9 * len(ls) THEN 'too_many_bullets'
    WHEN len(list_filter(ls, lambda l: regexp_matches(l, '([.][.][.]|…){WS}*$'))) > 0.3 * len(ls) THEN 'too_many_end_ellipsis'
    WHEN len(list_filter(ws, lambda w: regexp_matches(w, '\\p{{L}}'))) < 0.8 * len(ws) THEN 'below_alpha_words'
    WHEN len(list_distinct(list_filter(list_transform(ws, lambda w: lower(w)), lambda w: w IN ({STOPS})))) < 2 THEN 'too_few_stop_words' ELSE 'passed' END"""
_GOPHER_IN = f"SELECT doc_id, text, string_split(text, chr(10)) AS ls, {WORDS('text')} AS ws, list_avg(list_transform({WORDS('text')}, lambda w: length(w))) AS mean FROM {DOC} d WHERE text IS NOT NULL"


@book.add(f"SELECT doc_id, {_GOPHER} AS result FROM ({_GOPHER_IN})", per_row=True)
def gopher_quality(t):
    rows = t("documents").where(T().isNotNull()).select("doc_id", "text", Q.once(X.words(T())).alias("words"))
    return rows.select("doc_id", Q.gopher_quality_code(T(), F.col("words")).alias("result"))


_C4_LINES = r"""list_filter(list_transform(string_split(text, chr(10)), lambda l: regexp_replace({s}, '\[[0-9]*\]|\[edit\]|\[citation needed\]', '', 'g')),
    lambda l: NOT regexp_matches(l, '[^\s]{{500}}[^\s]{{501}}') AND {nw} >= 3 AND NOT contains(lower(l), 'javascript') AND NOT regexp_matches(lower(l), '{pol}'))""".format(s=STRIP("l"), nw=NW("l"), pol=Q.POLICY)
_C4 = f"""CASE WHEN regexp_matches(lower(text), 'lorem ipsum') THEN 'lorem_ipsum' WHEN contains(text, '{{') THEN 'curly_bracket'
    WHEN list_sum(list_transform(kept, lambda l: {COUNT('l', r'[.!?]+(?:\s|$)')})) < 5 OR len(kept) = 0 THEN 'too_few_sentences' ELSE 'passed' END"""


@book.add(f"SELECT doc_id, {_C4} AS result, len(kept) AS kept_lines FROM (SELECT doc_id, text, {_C4_LINES} AS kept FROM {DOC} d WHERE text IS NOT NULL)", per_row=True)
def c4_quality(t):
    rows = t("documents").where(T().isNotNull()).select("doc_id", "text", Q.c4_lines(T()).alias("kept"))
    return rows.select("doc_id", Q.c4_code(T(), F.col("kept")).alias("result"), F.size("kept").cast("bigint").alias("kept_lines"))


_REP = lambda x: f"(len({x}) - len(list_distinct({x}))) / greatest(len({x}), 1)"
_REPC = lambda x: f"(list_sum(list_transform({x}, lambda l: length(l))) - list_sum(list_transform(list_distinct({x}), lambda l: length(l)))) / greatest(length(text), 1)"


@book.add(f"""SELECT doc_id, round({_REP('ps')}, 6) AS dup_paragraphs, round(coalesce({_REPC('ps')}, 0), 6) AS dup_paragraph_chars, round({_REP('ls')}, 6) AS dup_lines, round(coalesce({_REPC('ls')}, 0), 6) AS dup_line_chars
    FROM (SELECT doc_id, text, list_filter(regexp_split_to_array({STRIP('text')}, '\\n{{2,}}'), lambda l: l <> '') AS ps, list_filter(regexp_split_to_array({STRIP('text')}, '\\n+'), lambda l: l <> '') AS ls FROM {DOC} d WHERE text IS NOT NULL)""", per_row=True)
def gopher_repetition_lines(t):
    return Q.line_repetition(t("documents").where(T().isNotNull()).select("doc_id", "text"))


@book.add(None, per_row=True)
def gopher_repetition(t):
    return Q.gopher_repetition(t("documents").select("doc_id", "text"), id="doc_id")


@book.add(f"""SELECT parsed_id, round(CASE WHEN n_chars = 0 AND n = 0 THEN 0.0 ELSE least(n_chars / 200, 1.0) * 0.35 + least(n / 3, 1.0) * 0.2 + (1 - least(bad / greatest(n_chars, 1) * 100, 1.0)) * 0.25
    + (CASE WHEN n = 0 THEN 0.5 ELSE 1 - empty / n END) * 0.2 END, 6) AS score FROM (SELECT parsed_id, length(text) AS n_chars, {COUNT('text', chr(0xFFFD))} AS bad, len(sections) AS n,
    len(list_filter(sections, lambda s: {STRIP("coalesce(s.text, '')")} = '')) AS empty FROM {PARSED} p)""", per_row=True)
def parse_quality(t):
    return t("parsed_docs").select("parsed_id", r6(Q.parse_quality(T(), F.col("sections"))).alias("score"))


_CHALLENGE = "CASE " + " ".join(f"WHEN regexp_matches(text, '(?is){sq(p.removeprefix('(?s)'))}') THEN '{sq(r)}'" for p, r in X.CHALLENGES) + " END"


@book.add(f"SELECT parsed_id, {_CHALLENGE} AS reason FROM {PARSED} p", per_row=True)
def challenge_filter(t):
    return t("parsed_docs").select("parsed_id", X.first_match(T(), X.CHALLENGES).alias("reason"))


def _folded(e: str) -> str:
    """NFKC in SQL: single characters by translate, expanding ones of the common blocks by replace, then composition."""
    pairs = [(c, n) for c in map(chr, [*range(0xA0, 0x2E80), *range(0x3000, 0x3400), *range(0xFB00, 0x10000)]) if not 0xD800 <= ord(c) < 0xE000 and (n := unicodedata.normalize("NFKC", c)) != unicodedata.normalize("NFC", c)]
    single = [(c, n) for c, n in pairs if len(n) == 1 and c != "'"]
    e = f"translate({e}, '{''.join(c for c, _ in single)}', '{''.join(sq(n) if n != chr(39) else chr(39) * 2 for _, n in single)}')"
    for c, n in pairs:
        if len(n) > 1 and ord(c) in (*range(0xA0, 0x100), *range(0x2010, 0x2040), *range(0x2100, 0x2160), *range(0xFB00, 0xFB07)):
            e = f"replace({e}, '{c}', '{sq(n)}')"
    return f"nfc_normalize({e})"


HASHED = lambda e: f"sha256({STRIP(_rr(_folded(e), WS + '+', ' '))})"


@book.add(f"SELECT chunk_id, {HASHED('text')} AS text_hash FROM {CH} c WHERE text IS NOT NULL", per_row=True)
def text_hash(t):
    return t("chunks").where(T().isNotNull()).select("chunk_id", X.text_hash(T()).alias("text_hash"))


NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
_SHA = f"sha1(unhex('{NAMESPACE.replace('-', '')}') || encode(content_hash))"
_UUID5 = "concat(h[1:8], '-', h[9:12], '-5', h[14:16], '-', ['8', '9', 'a', 'b'][(position(h[17:17] IN '0123456789abcdef') - 1) % 4 + 1], h[18:20], '-', h[21:32])"


@book.add(f"SELECT DISTINCT chunk_id, {_UUID5} AS point_id FROM (SELECT chunk_id, {_SHA} AS h FROM {CH} c WHERE content_hash IS NOT NULL)", per_row=True)
def point_id(t):
    return t("chunks").where(F.col("content_hash").isNotNull()).select("chunk_id", X.point_id(F.col("content_hash"), NAMESPACE).alias("point_id"))


@book.add(f"SELECT doc_id, len(d) AS n, array_to_string(d, '|') AS dates FROM (SELECT doc_id, regexp_extract_all(text, '{X.US_DATE}') AS d FROM {DOC} d WHERE text IS NOT NULL)", per_row=True)
def extract_dates(t):
    found = F.regexp_extract_all(T(), F.lit(f"({X.US_DATE})"), 1)
    return t("documents").where(T().isNotNull()).select("doc_id", F.size(found).cast("bigint").alias("n"), F.array_join(found, "|").alias("dates"))


@book.add(f"SELECT parsed_id, coalesce(nullif(title, ''), nullif(sections[1].heading, ''), '') AS title, array_to_string(list_transform(list_filter(sections, lambda s: s.heading <> ''), lambda s: s.heading), '|') AS headings FROM {PARSED} p", per_row=True)
def extract_title(t):
    first = F.get("sections", 0)["heading"]
    headings = F.transform(F.filter("sections", lambda s: s["heading"] != ""), lambda s: s["heading"])
    blank = lambda c: F.when(c != "", c)
    return t("parsed_docs").select("parsed_id", F.coalesce(blank(F.col("title")), blank(first), F.lit("")).alias("title"), F.array_join(headings, "|").alias("headings"))


_SLUG = _rr(_rr("lower(" + _rr("coalesce(title, '')", r"[^\x00-\x7f]") + ")", "[^a-z0-9]+", "-"), "^-+|-+$")


@book.add(f"SELECT parsed_id, CASE WHEN {_SLUG} = '' THEN 'untitled' ELSE {_SLUG} END AS slug FROM {PARSED} p", per_row=True)
def slugify(t):
    return t("parsed_docs").select("parsed_id", X.slugify(F.coalesce("title", F.lit(""))).alias("slug"))


@book.add(f"""SELECT doc_id, CASE WHEN length(text) <= 500 THEN text ELSE {_rr("CASE WHEN s <> '' THEN s WHEN contains(w, ' ') THEN regexp_extract(w, '(?s)^(.*) [^ ]*$', 1) ELSE w END", WS + '+$')} || '...' END AS lead
    FROM (SELECT doc_id, text, substring(text, 1, 500) AS w, regexp_extract(substring(text, 1, 500), '(?s)^(.*[.!?])(?: .*)?$', 1) AS s FROM {DOC} d WHERE text IS NOT NULL)""", per_row=True)
def truncate_lead(t):
    return t("documents").where(T().isNotNull()).select("doc_id", X.truncate_lead(T(), 500).alias("lead"))


def _signature(e: str) -> str:
    e = _boiler(e, X.BOILERPLATE[:4])
    for p in X.VOLATILE:
        e = _rr(e, p, "<volatile>")
    return f"sha256({e})"


@book.add(f"SELECT parsed_id, {_signature('text')} AS signature FROM {PARSED} p WHERE text IS NOT NULL", per_row=True)
def change_signature(t):
    return t("parsed_docs").where(T().isNotNull()).select("parsed_id", X.change_signature(T()).alias("signature"))


@book.add(f"""SELECT doc_id, len(s) AS sentences, list_sum(list_transform(s, lambda x: length(x))) AS chars FROM (SELECT doc_id,
    list_filter(list_transform(string_split({_rr(STRIP('text'), r'([.!?])\s+([A-Z])', chr(92) + '1' + chr(1) + chr(92) + '2')}, chr(1)), lambda x: {STRIP('x')}), lambda x: x <> '') AS s FROM {DOC} d WHERE text IS NOT NULL)""", per_row=True)
def split_sentences(t):
    s = X.sentences(T())
    return t("documents").where(T().isNotNull()).select("doc_id", s.alias("s")).select("doc_id", F.size("s").cast("bigint").alias("sentences"), F.when(F.size("s") > 0, F.aggregate("s", F.lit(0).cast("bigint"), lambda a, x: a + F.char_length(x))).alias("chars"))


_BARE = _rr(STRIP("url"), "#.*$")
_PATH = f"regexp_extract({_BARE}, '^[^:]+://[^/?]*([^?]*)', 1)"


@book.add(f"""SELECT id, lower(regexp_extract({_BARE}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || {_rr(f"lower(regexp_extract({_BARE}, '^[^:]+://([^/?]*)', 1))", '^.*@')}
    || CASE WHEN {_PATH} = '/' THEN '/' ELSE {_rr(_PATH, '/+$')} END || regexp_extract({_BARE}, '([?].*)$', 1) AS normalized FROM (SELECT DISTINCT * FROM sources) s""", per_row=True)
def normalize_url(t):
    return t("sources").select("id", X.normalize_url(F.col("url")).alias("normalized"))


_HITS = {lang: "len(list_filter(w, lambda x: x IN (" + ", ".join(f"'{x}'" for x in ws.split()) + ")))" for lang, ws in Q.LANGUAGE_WORDS.items()}
_BEST = "greatest(" + ", ".join(_HITS) + ")"


@book.add(f"""SELECT doc_id, CASE {' '.join(f"WHEN {x} = {_BEST} AND {_BEST} > 0 THEN '{x}'" for x in _HITS)} ELSE 'unknown' END AS detected FROM
    (SELECT doc_id, {', '.join(f'{h} AS {x}' for x, h in _HITS.items())} FROM (SELECT doc_id, {WORDS("lower(" + _rr("text", "[^" + chr(92) + "p{L}" + chr(92) + "s]", " ") + ")")} AS w FROM {DOC} d WHERE text IS NOT NULL))""", per_row=True)
def detect_language(t):
    return Q.detect_language(t("documents").where(T().isNotNull()), id="doc_id")


@book.add("SELECT item_id, CASE " + " ".join(f"WHEN regexp_matches(question, '{sq(p)}') THEN '{n}'" for n, p in X.ROUTES) + " ELSE 'no_match' END AS category FROM (SELECT DISTINCT * FROM eval_items)", per_row=True)
def classify_route(t):
    rules = [(p, n) for n, p in X.ROUTES]
    return t("eval_items").select("item_id", F.coalesce(X.first_match(F.col("question"), rules, ""), F.lit("no_match")).alias("category"))


@book.add(f"""WITH c AS (SELECT doc_id, lang, source, {_boiler('text', X.BOILERPLATE)} AS text FROM {DOC} d WHERE text IS NOT NULL),
    g AS (SELECT doc_id, lang, source, length(text) AS cleaned_chars, {_GATE} AS reason_code, sha256({STRIP(_rr('text', WS + '+', ' '))}) AS text_hash FROM c)
    SELECT doc_id, lang, source, cleaned_chars, reason_code, text_hash, row_number() OVER (PARTITION BY text_hash ORDER BY doc_id) = 1 AS kept FROM g""")
def corpus_clean_gate(t):
    cleaned = t("documents").where(T().isNotNull()).select("doc_id", "lang", "source", Q.once(X.remove_boilerplate(T())).alias("text"))
    cleaned = cleaned.select("*", Q.once(Q.signals(T())).alias("s"))
    gated = cleaned.select("doc_id", "lang", "source", F.char_length("text").cast("bigint").alias("cleaned_chars"), Q.code_of(F.col("s")).alias("reason_code"), F.sha2(X.strip(F.regexp_replace(T(), f"{WS}+", " ")), 256).alias("text_hash"))
    gated = cut(gated)
    first = cut(gated.groupBy("text_hash").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("n")))
    return skew_safe_lookup(gated, first, ["text_hash"], "n", gated.count()).select("doc_id", "lang", "source", "cleaned_chars", "reason_code", "text_hash", (F.col("doc_id") == F.col("_first")).alias("kept"))


_SECTIONS = f"""SELECT parsed_id, section_no, text, is_table, coalesce(nullif(s.domain, ''), nullif(s.config.domain, '')) AS domain FROM
    (SELECT parsed_id, source_id, CAST(unnest(range(len(sections))) AS INT) AS section_no, coalesce(unnest(sections).text, '') AS text, coalesce(unnest(sections).is_table, false) AS is_table FROM {PARSED} p) x
    LEFT JOIN (SELECT DISTINCT * FROM sources) s ON s.id = x.source_id"""
_ALLOWED = "CASE WHEN domain = 'healthcare' THEN CASE " + " ".join(f"WHEN regexp_matches(text, '{sq(p)}') THEN '{sq(p)}'" for p in Q.ALLOWED["healthcare"]) + " END END"
_MARKED = " OR ".join(f"regexp_matches(text, '{sq('(?' + p[2 : p.index(')')].replace('d', '') + ')' + p[p.index(')') + 1 :])}')" for p in X.BOILERPLATE)
_CLASS = f"""SELECT parsed_id, section_no, allow IS NOT NULL AS allowlisted, allow IS NULL AND (marked OR NOT is_table AND code <> 'all_checks_passed') AS is_boilerplate, cleaned = '' AS emptied,
    CASE WHEN allow IS NOT NULL THEN 'domain_allowlist_match:' || allow WHEN marked THEN 'boilerplate_pattern_match' WHEN NOT is_table AND code <> 'all_checks_passed' THEN code ELSE 'substance_ok' END AS reason
    FROM (SELECT *, {_ALLOWED} AS allow, {_MARKED} AS marked, {_GATE} AS code, {_boiler('text', X.BOILERPLATE)} AS cleaned FROM ({_SECTIONS}))"""
_KEPT = "CASE WHEN emptied THEN 'empty_after_boilerplate_removal' WHEN is_boilerplate THEN 'classified_as_boilerplate' ELSE 'kept' END"


def _classified(t):
    return Q.classified_sections(t("parsed_docs"), t("sources").dropDuplicates(["id"]), allowed=Q.ALLOWED)


def _outcome():
    return F.when(F.col("emptied"), "empty_after_boilerplate_removal").when(F.col("is_boilerplate"), "classified_as_boilerplate").otherwise("kept")


@book.add(f"SELECT parsed_id, section_no, allowlisted, is_boilerplate, reason FROM ({_CLASS})", per_row=True)
def classify_sections(t):
    return _classified(t).select("parsed_id", "section_no", "allowlisted", "is_boilerplate", "reason")


@book.add(f"SELECT parsed_id, section_no, {_KEPT} AS outcome, reason FROM ({_CLASS})", per_row=True)
def section_outcomes(t):
    return _classified(t).select("parsed_id", "section_no", _outcome().alias("outcome"), "reason")


@book.add(f"""SELECT parsed_id, count(*) AS considered, count(*) FILTER (r = 'kept') AS kept, count(*) FILTER (r = 'classified_as_boilerplate') AS boilerplate, count(*) FILTER (r = 'empty_after_boilerplate_removal') AS empty,
    count(*) = count(*) FILTER (r = 'kept') + count(*) FILTER (r <> 'kept') AS conserved FROM (SELECT parsed_id, {_KEPT} AS r FROM ({_CLASS})) GROUP BY parsed_id""")
def clean_sections(t):
    n = lambda r: F.count_if(F.col("r") == r)
    kept, dropped, empty = n("kept"), n("classified_as_boilerplate"), n("empty_after_boilerplate_removal")
    rows = _classified(t).select("parsed_id", _outcome().alias("r"))
    return rows.groupBy("parsed_id").agg(F.count(F.lit(1)).alias("considered"), kept.alias("kept"), dropped.alias("boilerplate"), empty.alias("empty"), (F.count(F.lit(1)) == kept + dropped + empty).alias("conserved"))


_CHUNK_ALLOWED = "CASE WHEN coalesce(nullif(s.domain, ''), nullif(s.config.domain, '')) = 'healthcare' THEN CASE " + " ".join(f"WHEN regexp_matches(text, '{sq(p)}') THEN '{sq(p)}'" for p in Q.ALLOWED["healthcare"]) + " END END"


@book.add(f"""SELECT chunk_id, reason_code FROM (SELECT chunk_id, CASE WHEN is_table THEN 'table_exempt' WHEN allow IS NOT NULL THEN 'domain_allowlist_match:' || allow WHEN fw <> 'passed' THEN 'fineweb_' || fw ELSE code END AS reason_code,
    coalesce(is_table, false) OR allow IS NOT NULL OR (fw = 'passed' AND code = 'all_checks_passed') AS passed
    FROM (SELECT chunk_id, is_table, {_CHUNK_ALLOWED} AS allow, {_FW} AS fw, {_GATE} AS code FROM (SELECT chunk_id, is_table, text, source_id, {_FW_LINES} AS ls FROM {CH} c) c LEFT JOIN (SELECT DISTINCT * FROM sources) s ON s.id = c.source_id)) WHERE passed""", per_row=True)
def chunk_gate_enforced(t):
    return Q.gated_chunks(t("chunks"), t("sources").dropDuplicates(["id"]), allowed=Q.ALLOWED, enforce=True).select("chunk_id", "reason_code")
