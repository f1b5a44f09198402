"""The shape of one text: running prose, list, table or junk. Pure functions."""

from __future__ import annotations

import re
from collections import Counter

from .furniture import NOTICE, folded
from .languages import COMMON

_FUNCTION = {w for words in COMMON.values() for w in words}
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_END = re.compile(r"(?:[.!?…।؟۔։።។][\"'”’»›」』）)\]]*(?=\s|$)|[。！？။])")
_MARKER = re.compile(r"\s*(?:[-*•‣–]\s+|\(?(?:\d{1,3}|[a-zA-Z]|[ivx]{1,4})[.)]\s+)(?=\S)")
_UNSPACED = re.compile(r"[぀-ヿ㐀-鿿฀-໿က-႟ក-៿]")
_OTHER = re.compile(r"[Ѐ-ӿ֐-׿؀-ۿऀ-෿ა-ჿ가-힣]")
_UNSEEN = "\u200b\u2060\ufeff\u00ad \u00a0"
_GAP = re.compile(r"\s{3,}|\t")
_MOJIBAKE = re.compile(r"[ƒ©€âÃÂ™„±¬¤�ï¿½]")
_CELL = re.compile(r"\s{3,}|\t|\|")
_RULE = re.compile(r"\|?[\s:|+=-]*-{2,}[\s:|+=-]*\|?$")


def is_sentence(text: str) -> bool:
    """Whether a stretch of text reads as a sentence or more, ended or not, in any script."""
    plain = text.isascii()
    if not plain and len(_UNSPACED.findall(text)) >= 10:
        return len(set(text)) >= 8
    words = _WORD.findall(text)
    long = [w for w in words if len(w) > 1]
    if len(long) < 4 or len(long) < 0.5 * len(words) or len({w.lower() for w in long}) < 3:
        return False
    if not plain and len(_MOJIBAKE.findall(text)) > 0.15 * len(text):
        return False
    if not plain and len(_OTHER.findall(text)) >= 12:
        return True
    tokens = text.split()
    if sum(len(t) for t in tokens if len(t) > 40 and "://" not in t) > 0.5 * len(text):
        return False
    common = sum(w.lower() in _FUNCTION for w in words)
    if _END.search(text):
        return common >= 1
    for piece in text.split("; "):
        inner = _WORD.findall(piece)
        common = sum(w.lower() in _FUNCTION for w in inner)
        if len(inner) >= 10 and common >= 3 and common >= 0.12 * len(inner):
            return True
    return False


def cells(line: str) -> int:
    """Cells of a line that is a table row, 1 if it is none."""
    line = line.strip("\r\n")
    if line.count("|") >= 2 and line.strip()[:1] == "|" or " | " in line:
        return max(2, line.strip().strip("|").count("|") + 1)
    if "\t" in line.strip(" "):
        return line.count("\t") + 1
    if len(_GAP.findall(line.strip())) >= 1 or re.match(r"\s{6,}\S", line):
        return len(_GAP.split(line.strip())) + bool(re.match(r"\s{6,}\S", line))
    bare = re.sub(r'"[^"]*"', "q", line)
    for mark in (";", ","):
        n = len(re.findall(rf"{mark}(?! )", bare)) + (bare.rstrip()[-1:] == mark and bare != bare.rstrip())
        if mark == ",":
            n = len(re.findall(r",(?! )", re.sub(r"(?<=\d),(?=\d{3}\b)", "", bare)))
        if n >= 2:
            return n + 1
    return 1


def shape(text: str | None) -> str:
    """`prose`, `list`, `table` or `junk`."""
    lines = [line for line in (text or "").split("\n") if line.strip().strip(_UNSEEN)]
    if not lines:
        return "junk"
    for line in lines:  # most texts show a plain sentence early
        if _END.search(line) and not _CELL.search(line.strip()) and cells(line) <= 1 and is_sentence(_MARKER.sub("", line, count=1)) and not NOTICE.match(folded(line)):
            return "prose"
    marked = sum(bool(_MARKER.match(line)) for line in lines)
    body = [_MARKER.sub("", line, count=1) for line in lines if not NOTICE.match(folded(line))]
    rows = [cells(line) for line in body]
    tabular = sum(n > 1 for n in rows)
    # Of a line with cells the longest one counts if it holds an ended sentence: sentences can stand far apart too.
    longest = [line if n <= 1 else max(_CELL.split(line), key=len) for line, n in zip(body, rows)]
    loose = [x for x, n in zip(longest, rows) if n <= 1 or _END.search(x) and len(_WORD.findall(x)) >= 5 and is_sentence(x) or len(_UNSPACED.findall(x)) >= 10]
    joined = " ".join(folded_case(line) for line in loose)
    if any(is_sentence(line) and _END.search(line) for line in loose):
        return "prose"
    wrapped = len(loose) >= 2 and max(map(len, loose)) >= 50 and marked < 2
    if loose and (any(is_sentence(line) for line in loose) or wrapped and is_sentence(joined) and _END.search(joined)):
        return "prose"
    if not body:
        return "list"  # notices only
    told = [line for line in body if not _RULE.match(line.strip())]
    visible = sum(not c.isspace() and c not in "|;,\"" for line in told for c in line)
    usable = sum(c.isalnum() for line in told for c in line)
    blocks = sum(len(x) for line in told for x in line.split() if len(x) > 32 and "://" not in x and not _UNSPACED.search(x))
    broken = len(_MOJIBAKE.findall(joined)) > 0.15 * visible
    if usable < 0.4 * visible or blocks > 0.5 * visible or broken:
        return "junk"
    if tabular > 0.5 * len(body):
        return "table"
    words = [w.lower() for line in body for w in _WORD.findall(line) if len(w) > 1]
    lettered = sum(len(w) for w in words)
    if _UNSPACED.search(joined):
        lettered = max(lettered, len(_UNSPACED.findall(joined)))
    top = Counter(words).most_common(1)[0][1] if words else 0
    if not words or lettered < 0.35 * visible or top > 0.5 * len(words) and len(words) >= 6 or not pronounceable(words):
        return "junk"
    return "list"


def folded_case(line: str) -> str:
    return " ".join(line.split())


def pronounceable(words: list[str]) -> bool:
    """Whether most Latin words have vowels and no endless consonant runs; other scripts count as pronounceable."""
    latin = [w for w in words if w.isascii() and len(w) > 2]
    if len(latin) < 3:
        return True
    odd = sum(not re.search(r"[aeiouy]", w) or bool(re.search(r"[^aeiouy]{6,}", w)) or len(w) > 28 for w in latin)
    return odd <= 0.4 * len(latin)
