"""Quality rules over text columns, each giving the code of the first rule that fails."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# Policy phrases of lines to drop.
POLICY = "terms of use|privacy policy|cookie policy|uses cookies|use of cookies|use cookies"
# Shares of characters allowed in the top n-gram, and in duplicated n-grams.
TOP_NGRAMS = {2: 0.20, 3: 0.18, 4: 0.16}
DUPLICATED_NGRAMS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}


def once(value: Column) -> Column:
    """The value from a generator, so that later expressions read it instead of computing it again each."""
    return F.explode(F.array(value))


def signals(text: Column) -> Column:
    """The ratios of the substance checks as a struct."""
    return F.struct(X.token_count(text).alias("tokens"), X.alpha_ratio(text).alias("alpha"), X.n_words(text).alias("words"), F.regexp_count(text, F.lit(X.LINK)).alias("links"), X.stopword_ratio(text).alias("stops"), X.terminal_count(text).alias("ends"))


def code_of(s: Column) -> Column:
    """Token floor, letters, links, stop words, end marks, in this order; the last three need six words."""
    enough = s["words"] >= 6
    return (
        F.when(s["tokens"] < 3, "below_token_floor").when(s["alpha"].isNull(), "empty_text").when(s["alpha"] < 0.5, "below_alpha_ratio")
        .when(enough & (s["links"] / s["words"] > 0.3), "above_link_density").when(enough & (s["stops"] < 0.05), "below_stopword_ratio")
        .when(enough & (s["ends"] / s["words"] < 0.02), "below_terminal_punct").otherwise("all_checks_passed")
    )


def substance_code(text: Column) -> Column:
    return code_of(signals(text))


# Patterns of texts that are never taken for boilerplate, by domain.
ALLOWED = {"healthcare": ["ICD-10", "LOINC", "RxNorm", r"§\d+\.\d+", r"\d+\s*mg", r"PO\s+BID", r"\d+\s*(?:of|/)\s*\d+\s+(?:SIRS|Duke|Ranson|SOFA|criteria|metabolic syndrome)"]}


def valid_patterns(patterns: list[str]) -> list[str]:
    """Those that are regular expressions; a malformed one matches nothing and must not stop the others."""
    found = []
    for p in patterns:
        try:
            re.compile(p)
        except re.error:
            continue
        found.append(p)
    return found


def allowed_by(text: Column, domain: Column, allowed: dict[str, list[str]]) -> Column:
    """The first pattern of the domain's list that is found in the text, else null."""
    found = F.lit(None).cast("string")
    for name, patterns in allowed.items():
        match = F.lit(None).cast("string")
        for p in reversed(valid_patterns(patterns)):
            match = F.when(text.rlike(p), F.lit(p)).otherwise(match)
        found = F.when(domain == name, match).otherwise(found)
    return found


def _domains(sources: DataFrame) -> DataFrame:
    """(source_id, domain), a few rows per registered source; broadcast up to the session's limit."""
    named = lambda c: F.when(F.col(c) != "", F.col(c))
    return sources.select(F.col("id").alias("source_id"), F.coalesce(named("domain"), named("config.domain")).alias("domain"))


def classified_sections(parsed: DataFrame, sources: DataFrame, *, allowed: dict[str, list[str]]) -> DataFrame:
    """(parsed_id, section_no, allowlisted, is_boilerplate, emptied, reason) of every section.

    An allowed pattern anywhere saves a section; else one boilerplate line condemns all of it; else the substance checks decide,
    from which tables are exempt. emptied: nothing is left without its boilerplate lines, which condemns allowed ones too. Null
    texts count as empty, unknown sources as without a domain.
    """
    text = F.col("text")
    rows = parsed.select("parsed_id", "source_id", F.posexplode("sections").alias("section_no", "s")).select("parsed_id", "source_id", "section_no", F.coalesce("s.text", F.lit("")).alias("text"), F.coalesce("s.is_table", F.lit(False)).alias("is_table"))
    rows = rows.join(_domains(sources), "source_id", "left")
    marked = F.lit(False)
    for p in X.BOILERPLATE:
        marked = marked | text.rlike(X.java(p))
    facts = F.struct(allowed_by(text, F.col("domain"), allowed).alias("allow"), marked.alias("marked"), signals(text).alias("signals"), (X.remove_boilerplate(text) == "").alias("emptied"))
    rows = rows.select("parsed_id", "section_no", "is_table", once(facts).alias("f"))
    code = F.when(F.col("is_table"), "all_checks_passed").otherwise(code_of(F.col("f.signals")))
    saved, bad = F.col("f.allow").isNotNull(), F.col("code") != "all_checks_passed"
    reason = F.when(saved, F.concat(F.lit("domain_allowlist_match:"), "f.allow")).when(F.col("f.marked"), "boilerplate_pattern_match").when(bad, F.col("code")).otherwise("substance_ok")
    rows = rows.withColumn("code", code)
    return rows.select("parsed_id", "section_no", saved.alias("allowlisted"), (~saved & (F.col("f.marked") | bad)).alias("is_boilerplate"), F.col("f.emptied").alias("emptied"), reason.alias("reason"))


def gated_chunks(chunks: DataFrame, sources: DataFrame, *, allowed: dict[str, list[str]], enforce: bool) -> DataFrame:
    """chunks with reason_code and passed: tables and allowed texts are exempt, then the line rules, then the substance checks.
    With enforce only those that passed, else all with their outcome."""
    text = F.col("text")
    both = F.struct(signals(text).alias("s"), fineweb_code(text).alias("fw"), allowed_by(text, F.col("_domain"), allowed).alias("allow"))
    rows = chunks.join(_domains(sources).withColumnRenamed("domain", "_domain"), "source_id", "left").withColumn("_b", once(both))
    reason = F.when(F.col("is_table"), "table_exempt").when(F.col("_b.allow").isNotNull(), F.concat(F.lit("domain_allowlist_match:"), "_b.allow"))
    reason = reason.when(F.col("_b.fw") != "passed", F.concat(F.lit("fineweb_"), "_b.fw")).otherwise(code_of(F.col("_b.s")))
    good = F.coalesce("is_table", F.lit(False)) | F.col("_b.allow").isNotNull() | ((F.col("_b.fw") == "passed") & (F.col("reason_code") == "all_checks_passed"))
    rows = rows.withColumn("reason_code", reason).withColumn("passed", good).drop("_b", "_domain")
    return rows.where("passed") if enforce else rows


def _chars(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("bigint"), lambda a, x: a + F.char_length(x))


def fineweb_code(text: Column) -> Column:
    lines = F.filter(F.transform(F.split(text, "\n", -1), X.strip), lambda x: x != "")
    n = F.size(lines)
    ended = F.size(F.filter(lines, X.ends_sentence))
    short = F.size(F.filter(lines, lambda x: F.char_length(x) <= 30))
    return (
        F.when(text.isNull(), None).when(n == 0, "empty").when(ended / n < 0.12, "line_punct_ratio").when(short / n > 0.67, "short_line_ratio")
        .when(1 - _chars(F.array_distinct(lines)) / _chars(lines) > 0.01, "char_dup_ratio")
        .when(F.regexp_count(text, F.lit("\n")) > 0.3 * X.n_words(text), "list_ratio").otherwise("passed")
    )


def gopher_quality_code(text: Column, words: Column) -> Column:
    lines = F.split(text, "\n", -1)
    n, k = F.size(words), F.size(lines)
    mean = _chars(words) / n
    share = lambda pattern: F.size(F.filter(lines, lambda x: x.rlike(pattern))) / k
    stops = F.size(F.array_distinct(F.filter(F.transform(words, F.lower), lambda w: w.isin(X.STOP_WORDS))))
    return (
        F.when(n < 50, "short_doc").when(n > 100000, "long_doc").when(mean < 3, "below_avg_word_length").when(mean > 10, "above_avg_word_length")
        .when(F.regexp_count(text, F.lit("#")) > 0.1 * n, "too_many_hashes").when(F.regexp_count(text, F.lit("[.][.][.]|…")) > 0.1 * n, "too_many_ellipsis")
        .when(share(f"^{X.WS}*[-•*]") > 0.9, "too_many_bullets").when(share(f"([.][.][.]|…){X.WS}*$") > 0.3, "too_many_end_ellipsis")
        .when(F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))) < 0.8 * n, "below_alpha_words").when(stops < 2, "too_few_stop_words").otherwise("passed")
    )


def c4_lines(text: Column) -> Column:
    """Lines kept: citation marks dropped, at least three words, none too long, no script or policy notes."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.regexp_replace(X.strip(x), r"\[[0-9]*\]|\[edit\]|\[citation needed\]", ""))
    return F.filter(lines, lambda x: ~x.rlike(r"[^\s]{1001,}") & (X.n_words(x) >= 3) & ~F.lower(x).contains("javascript") & ~F.lower(x).rlike(POLICY))


def c4_code(text: Column, kept: Column) -> Column:
    ends = F.aggregate(kept, F.lit(0), lambda a, x: a + F.regexp_count(x, F.lit(r"[.!?]+(?:\s|$)")))
    return F.when(F.lower(text).contains("lorem ipsum"), "lorem_ipsum").when(text.contains("{"), "curly_bracket").when(ends < 5, "too_few_sentences").otherwise("passed")


def line_repetition(docs: DataFrame) -> DataFrame:
    """Shares of repeated paragraphs and lines, by number and by characters, of (doc_id, text)."""
    text = X.strip(F.col("text"))
    rows = docs.select("doc_id", F.char_length("text").alias("n"), *[F.filter(F.split(text, p, -1), lambda x: x != "").alias(c) for c, p in (("ps", r"\n{2,}"), ("ls", r"\n+"))])
    share = lambda c: F.round((F.size(c) - F.size(F.array_distinct(c))) / F.greatest(F.size(c), F.lit(1)), 6)
    chars = lambda c: F.round((_chars(F.col(c)) - _chars(F.array_distinct(c))) / F.greatest("n", F.lit(1)), 6)
    return rows.select("doc_id", share("ps").alias("dup_paragraphs"), chars("ps").alias("dup_paragraph_chars"), share("ls").alias("dup_lines"), chars("ls").alias("dup_line_chars"))


def repetition_code(text: str | None) -> str | None:
    """The first repetition rule that a text breaks, null for none. N-grams are over words without white space."""
    text = (text or "").strip()
    if not text:
        return None
    for name, parts, most, most_chars in (("paragraph", re.split(r"\n{2,}", text), 0.3, 0.2), ("line", re.split(r"\n+", text), 0.3, 0.2)):
        parts = [p for p in parts if p]
        unique = set(parts)
        if (len(parts) - len(unique)) / len(parts) > most:
            return f"dup_{name}_frac"
        if (sum(map(len, parts)) - sum(map(len, unique))) / len(text) > most_chars:
            return f"dup_{name}_char_frac"
    words = text.split()
    for n, most in TOP_NGRAMS.items():
        grams = Counter(zip(*[words[i:] for i in range(n)]))
        if grams:
            gram, count = max(grams.items(), key=lambda x: (x[1] > 1) * x[1] * (sum(map(len, x[0])) + n - 1))
            if count > 1 and count * (sum(map(len, gram)) + n - 1) / len(text) > most:
                return f"top_{n}_gram"
    for n, most in DUPLICATED_NGRAMS.items():
        seen, repeated, i = set(), 0, 0
        while i + n <= len(words):
            gram = tuple(words[i : i + n])
            if gram in seen:
                repeated += sum(map(len, gram))
                i += n
            else:
                seen.add(gram)
                i += 1
        if repeated / len(text) > most:
            return f"duplicated_{n}_n_grams"
    return None


def gopher_repetition(docs: DataFrame, *, id: str, text: str = "text") -> DataFrame:
    """(id, passed, reason) by repetition_code; null and blank texts pass."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            reasons = [repetition_code(x) for x in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "passed": [r is None for r in reasons], "reason": pd.Series(reasons, dtype=object)})

    kind = dict(docs.dtypes)[id]
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInPandas(judge, f"id {kind}, passed boolean, reason string").withColumnRenamed("id", id)


def parse_quality(text: Column, sections: Column) -> Column:
    """0.35 length + 0.20 sections + 0.25 readable encoding + 0.20 filled sections; 0 for an empty document."""
    n, k = F.char_length(text), F.size(sections)
    bad = F.regexp_count(text, F.lit("�")) / F.greatest(n, F.lit(1))
    empty = F.size(F.filter(sections, lambda s: X.strip(F.coalesce(s["text"], F.lit(""))) == ""))
    score = F.least(n / 200, F.lit(1.0)) * 0.35 + F.least(k / 3, F.lit(1.0)) * 0.2 + (1 - F.least(bad * 100, F.lit(1.0))) * 0.25 + F.when(k == 0, 0.5).otherwise(1 - empty / k) * 0.2
    return F.when((n == 0) & (k == 0), 0.0).otherwise(score)


# Function words by which a language is told.
LANGUAGE_WORDS = {
    "en": "the of and to in is that for with was are be this by from",
    "es": "el la de que y los se del las por un para con una su no al",
    "fr": "le la les de des et un une du que est pour dans qui sur pas au",
    "de": "der die das und den von zu mit sich des auf für ist im dem nicht ein",
    "pt": "o a os as de do da que e em um para com uma não no na por",
}


def _one_of(words: list[str]):
    return lambda w: w.isin(words)


def detect_language(docs: DataFrame, *, id: str, text: str = "text") -> DataFrame:
    """(id, detected): of en, es, fr, de, pt the one whose words are most frequent in the text, ties in that order; unknown
    for blank texts and texts with none."""
    words = X.words(F.lower(F.regexp_replace(F.col(text), r"[^\p{L}\s]", " ")))
    rows = docs.select(id, words.alias("w"))
    hits = [F.size(F.filter("w", _one_of(ws.split()))).alias(lang) for lang, ws in LANGUAGE_WORDS.items()]
    best = F.greatest(*LANGUAGE_WORDS)
    found = F.lit("unknown")
    for lang in reversed(LANGUAGE_WORDS):
        found = F.when((F.col(lang) == best) & (best > 0), lang).otherwise(found)
    return rows.select(id, *hits).select(id, found.alias("detected"))
