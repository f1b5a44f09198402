"""Per-section text statistics, exact per-language ranks and outlier scores; sections that are no running prose.

Statistics: word count, mean word length, share of symbols among visible characters, share of lines ending in punctuation,
share of common words. Their exact ranks within the language of the document come from one range-partitioned sort of the
distinct values, counted beforehand, with partition offsets, so no language is gathered into one task. A value's two
tail probabilities are the shares of sections with smaller and with larger values, each with half of the sections of the same
value, so a value that most sections share is not certain to be typical. An outlier score sums, for the
tails in which non-prose lies (few sentence ends, few common words, many symbols) and for the smaller tail of the other
two, -log of the probability.

A section whose score reaches SCORE is a candidate. Five independent statistics of an ordinary section add up to five nats on
average; as prose keeps its tails together, hardly any prose gets there. Where less than half of a language's sections end half of
their lines in punctuation, ranks cannot tell what is unusual there, so all its sections are candidates; this depends on the
language's distribution only, not on its size. Of the candidates those that hold a readable sentence are let go (a page can mix
both), the others are named list, table or junk by their shape.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, running_totals, skew_safe_lookup
from .languages import COMMON, scores
from .shapes import _WORD, shape

STATISTICS = ("word_count", "mean_word_length", "symbol_ratio", "punctuated_lines", "common_words")
#: The tail that counts of each statistic: low, high, or the smaller of both.
TAILS = {"word_count": "both", "mean_word_length": "both", "symbol_ratio": "high", "punctuated_lines": "low", "common_words": "low"}
SCORE = 5.0
#: Share of sections with at least half of their lines ended from which a language counts as mostly prose.
MOSTLY = 0.5
_ENDS = frozenset(".!?…。！？।؟۔։።။។:;\"'”’»)」』）")
_COMMON = {lang: frozenset(ws) for lang, ws in COMMON.items()}
_BLANK, _SYMBOL = re.compile(r"\s+"), re.compile(r"[\W_]+")
_EVERY = frozenset(w for ws in COMMON.values() for w in ws)


def statistics(text: str | None, lang: str | None = None) -> tuple[int, float, float, float, float]:
    """The statistics of a text in the order of STATISTICS; zeros where there is nothing to count.

    Words are runs of letters; common words those of the language's list, or of any list for other languages.
    """
    text = text or ""
    words = _WORD.findall(text)
    visible = len(_BLANK.sub("", text))
    lines = [line.rstrip() for line in text.split("\n") if line.strip()]
    common = _COMMON.get(lang, _EVERY)
    n = len(words)
    return (
        n,
        sum(map(len, words)) / n if n else 0.0,
        1 - len(_SYMBOL.sub("", text)) / visible if visible else 0.0,
        sum(line[-1] in _ENDS for line in lines) / len(lines) if lines else 0.0,
        sum(w in common for w in map(str.lower, words)) / n if n else 0.0,
    )


def section_statistics(docs: DataFrame, *, doc: str = "parsed_id", sections: str = "sections") -> DataFrame:
    """(doc, section_no, lang, the statistics, shape) of every section.

    lang is the language with most evidence in all of the document's sections, `und` without any. Null texts count as empty; a
    document without sections gives no rows. Documents delivered twice come out once.
    """
    columns = "doc string, section_no int, lang string, word_count bigint, mean_word_length double, symbol_ratio double, punctuated_lines double, common_words double, shape string"
    slim = docs.select(F.col(doc).cast("string").alias("doc"), F.transform(F.col(sections), lambda s: s["text"]).alias("texts")).where(F.col("doc").isNotNull() & F.col("texts").isNotNull())

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, texts in zip(batch["doc"], batch["texts"]):
                found: dict[str, float] = {}
                for t in texts:
                    for lang, x in scores(t).items() if t else ():
                        found[lang] = found.get(lang, 0.0) + x
                lang = max(sorted(found), key=found.__getitem__) if found else "und"
                out += [(name, i, lang, *statistics(t, lang), shape(t)) for i, t in enumerate(texts)]
            yield pd.DataFrame(out, columns=["doc", "section_no", "lang", *STATISTICS, "shape"])

    return slim.mapInPandas(measure, columns).distinct()


def outlier_scores(rows: DataFrame, *, group: str = "lang") -> DataFrame:
    """rows with each statistic's exact fractional rank `<statistic>_rank` within its group, `score`, the group's `size` and its
    share `ended` of rows with punctuated_lines of a half or more.

    The rank is the share of the group's rows with at most that value; ties share it. A null group is a group; null statistics
    count as the lowest value.
    """
    rows = cut(rows)
    total = rows.count()
    keyed = rows.withColumn("_group", F.coalesce(F.col(group).cast("string"), F.lit("")))
    pairs = F.array(*[F.struct(F.lit(k).alias("stat"), F.coalesce(F.col(s).cast("double"), F.lit(float("-inf"))).alias("value")) for k, s in enumerate(STATISTICS)])
    counted = keyed.select("_group", F.explode(pairs).alias("p")).groupBy("_group", F.col("p.stat").alias("stat"), F.col("p.value").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    below = running_totals(counted, ["_group", "stat"], ["value"], "n", "upto")
    ended = F.avg(F.when(F.col("punctuated_lines") >= 0.5, 1.0).otherwise(0.0))
    sizes = keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("size"), ended.alias("ended"))
    table = cut(below.join(sizes, "_group").select("_group", "stat", "value", "n", (F.col("upto") / F.col("size")).alias("rank"), ((F.col("upto") - F.col("n") / 2) / F.col("size")).alias("low"), ((F.col("size") - F.col("upto") + F.col("n") / 2) / F.col("size")).alias("high")))
    # Equal rows share all their ranks: they are looked up once.
    profile = keyed.groupBy("_group", *STATISTICS).agg(F.count(F.lit(1)).alias("_n"))
    profile = cut(profile.withColumn("_profile", F.monotonically_increasing_id()))
    long = profile.select("_profile", "_group", F.explode(pairs).alias("p")).select("_profile", "_group", F.col("p.stat").alias("stat"), F.col("p.value").alias("value"))
    ranked = skew_safe_lookup(long, table, ["_group", "stat", "value"], "n", total * len(STATISTICS))
    of = lambda k, c: F.max(F.when(F.col("stat") == k, F.col(c)))
    wide = ranked.groupBy("_profile").agg(*[of(k, c).alias(f"{s}_{c}") for k, s in enumerate(STATISTICS) for c in ("rank", "low", "high")])
    tail = lambda s: F.col(f"{s}_{TAILS[s]}") if TAILS[s] != "both" else F.least(f"{s}_low", f"{s}_high", F.lit(0.5)) * 2
    wide = wide.select("_profile", *[f"{s}_rank" for s in STATISTICS], (-sum((F.log(tail(s)) for s in STATISTICS), F.lit(0.0))).alias("score"))
    found = cut(profile.join(wide, "_profile").join(sizes, "_group").drop("_profile"))
    return skew_safe_lookup(keyed, found.withColumnRenamed("_n", "n"), ["_group", *STATISTICS], "n", total).drop("_group")


def not_prose(docs: DataFrame, *, doc: str = "parsed_id", sections: str = "sections", least: float = SCORE) -> DataFrame:
    """(doc, section_no, kind, score, lang, the statistics) of the sections that are list, table or junk."""
    scored = outlier_scores(section_statistics(docs, doc=doc, sections=sections))
    candidate = (F.col("score") >= least) | (F.col("ended") < MOSTLY)
    return scored.where(candidate & (F.col("shape") != "prose")).select("doc", "section_no", F.col("shape").alias("kind"), "score", "lang", *STATISTICS)
