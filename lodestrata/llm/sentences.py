"""Sentence units of texts in many scripts: character-property rules, abbreviations, quotations.

A text is parted at blank lines, then into list items (a marker at the start of a line) and running text, in which a single
line break is white space. Within running text the sentence-break rules of Unicode text segmentation decide: a terminator
with its closing marks ends a sentence, unless it is a full stop followed by a lower-case letter or a figure; language lists
of abbreviations suppress ends after titles and the like; terminators inside a quotation don't count, and one right before
a closing mark counts if what follows can begin a sentence. Scripts whose sentences end at a space (Thai) are cut there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .languages import guess

#: Sentence terminators of all scripts, by their Unicode property: Sentence_Break=ATerm, and STerm with the ellipsis.
FULL_STOPS, ENDS = ("".join(c for c in map(chr, range(0x21, 0x1FFFF)) if regex.match(rf"[\p{{Sentence_Break={kind}}}{more}]", c)) for kind, more in (("ATerm", ""), ("STerm", "…")))
CLOSERS = "\"'”’»›)]}」』）】》〉］｝“"
# Abbreviations that never end a sentence, without their last stop, in lower case.
NEVER = set(
    "dr dra mr mrs ms prof st mx rev hon gen col sgt capt lt messrs sr sra srta dña mme mlle mlles hr fr frl med dipl ing "
    "nr núm num pág págs pag fig figs tab abb kap bd ver approx ca cf vs viz e.g i.e eg ie mfg dept vol ch abs "
    "bzw vgl z.b d.h u.a s.u evtl ggf inkl zzgl bspw sog p.ej ej aprox tel rue av env éd chap "
    "рис табл стр ул пр д-р проф акад напр т.ч т.е т.д डॉ श्री प्रो د أ م".split()
)
# Abbreviations that end a sentence only before a capital or an opening mark.
SOMETIMES = set(
    "p.m a.m pm am inc co corp ltd llc plc bros etc u.s u.k u.n e.u d.c jr esq ph.d m.d hosp ave blvd rd assn univ est "
    "jan feb mar apr jun jul aug sept sep oct nov dec usw etc jh jhd std ud uds cía s.a s.l гг г руб коп др".split()
)
# Abbreviations of some languages that are words or units elsewhere.
SOME_LANGUAGES = {"mm": "fr", "ex": "fr pt", "art": "es fr de it pt", "arts": "es fr it pt", "par": "es fr de", "sec": "es", "см": "ru", "им": "ru"}
#: Followed by a figure these are references ("No. 14", "p. 24").
BEFORE_FIGURE = set("no nos n p pp pg s t c cap capt art arts par sec ex см".split())
# Russian pronouns; what stands before them ("gave them.") is no abbreviation.
_PRONOUN = re.compile(r"\s+(?:Он|Она|Они|Оно|Мы|Вы|Я|Это|Эта|Этот|Его|Её|Их)\b")
_EXAMPLE = re.compile(r"\b[pP]\.\s*e[xj]$")
_MEASURE = re.compile(r"\d\s*\S+$")
# What a German ordinal can stand before.
ORDINAL = re.compile(
    r"\s+(?:Januar|Jänner|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Quartal|Jahrhundert|Halbjahr|"
    r"Jahr|Monat|Woche|Tag|Stunde|Mal|Kapitel|Abschnitt|Absatz|Artikel|Auflage|Klasse|Stock|Etage|Lebensjahr)"
)
LIST_ITEM = re.compile(r"[^\S\n]*(?:[-*•‣◦▪·–—+][^\S\n]+|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,4})\)[^\S\n]+|\d{1,3}\.[^\S\n]+)\S")
BULLET = re.compile(r"[^\S\n]*[-*•‣◦▪·–—+(]")
HEADING = re.compile(r"#{1,6}[^\S\n]")
BLANK = re.compile(r"\n(?:[^\S\n]*\n)+")
_END = re.compile(rf"[{re.escape(FULL_STOPS + ENDS)}]+(?:[{re.escape(CLOSERS)}]|\s[»›])*")
_QUOTES = re.compile(r'"[^"]+"|«[^«»]+»|„[^„“”]+[“”]|“[^“”]+”|「[^「」]+」|『[^『』]+』|‹[^‹›]+›|「[^」]+」')
_TOKEN = re.compile(r"\S*$")
_GOES_ON = re.compile(r"(?:然后|随后|之后|接着|并|而|就|便|再|又|才|也|还|后|时|的|等|[とっにをはがのもやへで])")
_THAI_GAP = re.compile(r"(?<=[฀-๿຀-໿])\s+(?=[^\sA-Za-z0-9])|(?<=[^\sA-Za-z0-9])\s+(?=[฀-๿຀-໿])")
_DIGITS = re.compile(r"(?<![\w.,§-])\d{1,2}$")


def _starts(text: str, at: int, end: int) -> str:
    """The first letter, figure or mark at or after `at`, opening marks skipped."""
    while at < end and (text[at].isspace() or text[at] in "\"'“‘«„([{‹「『（¿¡*•-–—"):
        at += 1
    return text[at : at + 2]


def _ends_sentence(text: str, start: int, m: re.Match, end: int) -> bool:
    stop, after = m.start(), m.end()
    mark = m[0]
    if after >= end:
        return True
    stops = mark.rstrip(CLOSERS + "   ")
    closed = len(mark) > len(stops)
    following = _starts(text, after, end)
    spaced = text[after].isspace()
    first = following[:1]
    lower = first.islower() and not following[1:].isupper()
    if any(c not in FULL_STOPS and c != "…" for c in stops):
        if closed:
            return not (lower or _GOES_ON.match(text, after))
        if not spaced and stops[-1] in "!?" and (first.isdigit() or lower or first in "=&/%#,;:"):
            return False  # inside a link or the like
        return not text[after : after + 1] in ",;:，；："
    if len(stops) > 1 or "…" in stops:  # an ellipsis
        return not lower and (spaced or first.isupper() or closed)
    before = text[max(start, stop - 24) : stop]
    token = _TOKEN.search(before)[0].lstrip("\"'“‘«„([{‹¿¡").lower().split("'")[-1].split("’")[-1]
    if not spaced and not closed:
        # Without a space only between a word or figure and a capital, or two letters of a script without case.
        left = text[stop - 1] if stop > start else ""
        if text[after] in "¿¡«„":
            return True
        if not left.isalnum() or not text[after].isalpha() or text[after].islower() or left.isupper() or token in NEVER:
            return False
        if text[after].isupper():
            word = re.search(r"[^\W\d_]*$", before)[0]
            nearby = text[after + 1 : after + 2]
            return (left.isdigit() or len(word) > 1 and word[-1].islower()) and not nearby.isdigit() and (nearby != "." or len(word) > 2)
        return left.isalpha()
    if lower:
        return False
    if closed:
        return True
    if token in NEVER or _EXAMPLE.search(before):
        return False
    if token in SOME_LANGUAGES and not _MEASURE.search(before) and not _PRONOUN.match(text, after) and guess(text[max(0, stop - 500) : after + 500]) in SOME_LANGUAGES[token].split():
        return False
    if token in BEFORE_FIGURE and first.isdigit():
        return False
    if token in SOMETIMES:
        return not first.isdigit()
    if len(token) == 1 and token.isalpha() and not token > "฀":
        return False  # an initial
    if _DIGITS.search(before) and ORDINAL.match(text, after):
        return False
    return True


def _running(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    quoted = [m.span() for m in _QUOTES.finditer(text, start, end)]
    cuts = []
    begin, q = start, 0
    for m in _END.finditer(text, start, end):
        while q < len(quoted) and quoted[q][1] <= m.start():
            q += 1
        if q < len(quoted) and quoted[q][0] < m.start() and m.end() < quoted[q][1]:
            continue
        if q < len(quoted) and quoted[q][0] < m.start() and m.end() > quoted[q][1] and m[0][-1] in "\"“" and text[m.end() - 1] in "\"“" and m.end() - 1 >= quoted[q][1]:
            # The last mark opens the next quotation.
            m2 = _END.match(text, m.start(), quoted[q][1])
            if m2 and _ends_sentence(text, begin, m2, end):
                cuts.append(m2.end())
                begin = m2.end()
            continue
        if m[0][-1] in "\"“" and not (q < len(quoted) and quoted[q][0] < m.start()):
            # An opening mark right after the stop, no closing one.
            m2 = re.compile(rf"[{re.escape(FULL_STOPS + ENDS)}]+").match(text, m.start(), m.end())
            if _ends_sentence(text, begin, m2, end):
                cuts.append(m2.end())
                begin = m2.end()
            continue
        if _ends_sentence(text, begin, m, end):
            cuts.append(m.end())
            begin = m.end()
    if any("฀" <= c <= "໿" for c in text[start:end]):
        cuts += [m.start() for m in _THAI_GAP.finditer(text, start, end)]
        cuts.sort()
    at = start
    for c in [*cuts, end]:
        if c > at:
            yield at, c
            at = c


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) code points of the sentence units of text, white space around them excluded."""
    spans: list[tuple[int, int]] = []

    def add(a: int, b: int) -> None:
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            spans.append((a, b))

    at, edges = 0, []
    for m in BLANK.finditer(text):
        edges.append((at, m.start()))
        at = m.end()
    edges.append((at, len(text)))
    for a, b in edges:
        block, running, listed = a, a, False
        while block < b:
            line_end = text.find("\n", block, b)
            line_end = b if line_end < 0 else line_end
            item = LIST_ITEM.match(text, block, line_end)
            alone = HEADING.match(text, block, line_end)
            if alone or item and (listed or not text[running:block].strip() or BULLET.match(text, block, line_end)):
                for x, y in [(running, block)] if listed else _running(text, running, block):
                    add(x, y)
                running, listed = block, bool(item)
                if alone:
                    add(block, line_end)
                    running, listed = line_end, False
            block = line_end + 1
        for x, y in [(running, b)] if listed else _running(text, running, b):
            add(x, y)
    return spans


def sentences(documents: DataFrame, *, id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """(id, start_char, end_char[, sentence]) of the sentence units of every document.

    Offsets are code points from 0. Null, empty and blank texts have no units. Repeated (id, text) rows count once: the result
    is distinct; rows with a null id keep it.
    """
    kind = dict(documents.dtypes)[id]
    schema = f"id {kind}, start_char bigint, end_char bigint" + (", sentence string" if with_text else "")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, starts, ends, texts = [], [], [], []
            for name, body in zip(batch["id"], batch["text"]):
                for a, b in sentence_spans(body):
                    ids.append(name)
                    starts.append(a)
                    ends.append(b)
                    if with_text:
                        texts.append(body[a:b])
            out = {"id": pd.Series(ids, dtype=batch["id"].dtype), "start_char": starts, "end_char": ends}
            yield pd.DataFrame(out | ({"sentence": texts} if with_text else {}))

    rows = documents.select(F.col(id).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    # Repeated rows fall together as texts if texts come out, else as offsets, which are less to shuffle.
    units = rows.distinct().mapInPandas(split, schema) if with_text else rows.mapInPandas(split, schema).distinct()
    return units.withColumnRenamed("id", id)
