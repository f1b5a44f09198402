"""Defective prompt-response pairs: ordered rules that emit every defect type they find."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .languages import guess, scores
from .sentences import NEVER, sentence_spans

DEFECTS = ("empty", "copy", "refusal", "language", "truncated")

# What stands for a missing answer, in lower case without surrounding marks.
PLACEHOLDERS = {
    "n/a", "na", "n.a", "null", "none", "nil", "nan", "undefined", "tbd", "tba", "todo", "to be determined", "to be added", "to be done", "pending", "placeholder",
    "answer", "your answer", "your answer here", "answer here", "insert answer", "insert answer here", "output", "response", "empty", "blank", "missing",
    "no answer", "not available", "not provided", "xxx", "xx", "...", "lorem ipsum", "s/o", "k. a", "keine angabe", "sin respuesta", "sans réponse", "pas de réponse", "ohne antwort",
}
# Phrases that open a refusal, in lower case with straight apostrophes.
REFUSAL = re.compile(
    "(?:" + "|".join([
        r"(?:i am|i'm|we are|we're) (?:so |very |truly |really )?(?:sorry|afraid|unable|not able|not allowed|not permitted|not in a position)", r"(?:so |very )?sorry\b,?.{0,40}(?:can't|cannot|unable|not able|against|won't|guidelines|don't)", r"(?:my )?apologies\b", r"i (?:must|have to|need to|would have to|'ll have to) (?:decline|refuse|pass)", r"i (?:can't|cannot|can not|couldn't|could not|won't|will not|wouldn't|would not|don't|do not|am not)\b.{0,60}\b(?:answer|help|assist|provide|give|comment|discuss|respond|say|tell|share|offer|able|know|enough|information|comply|continue|fulfil|support|determine|advice|speculate|access)",
        r"i (?:refuse|decline|regret)\b", r"i'd (?:rather|prefer) not\b", r"as an? (?:ai|artificial|large|language|virtual|digital|chat)", r"unfortunately,? (?:i|we|this|that|it|there)\b.{0,60}(?:not|cannot|can't|unable|no )", r"that is not something i|that's not something i|this is not something i", r"it (?:isn't|is not) (?:possible|appropriate) for (?:me|us)\b", r"it would (?:not be|be in)\s?appropriate", r"(?:this|your|the) (?:request|question) (?:goes against|violates|is against|falls outside|is outside|cannot be|can't be|is not something)", r"(?:the|this) (?:excerpt|text|passage|context|document|source|input|note|material|information)(?: given| provided)? (?:does not|doesn't|do not|gives no|contains no|has no|offers no)\b.{0,60}(?:so|answer|say|mention|enough|information|specify|state)", r"no answer (?:can be|is|could be)", r"there is (?:not enough|no|insufficient) (?:information|context|data).{0,60}(?:answer|say|determine|respond)?", r"(?:we|our team) (?:cannot|can't|are unable)\b.{0,50}(?:answer|help|assist|provide|respond)",
        r"lo (?:siento|lamento)\b", r"lamento\b", r"lamentablemente\b", r"me temo que\b", r"no (?:puedo|me es posible|estoy (?:autorizado|autorizada|en condiciones))\b", r"no es posible (?:responder|contestar|dar|ayudar)", r"como (?:modelo|inteligencia|asistente|ia)\b", r"disculp[ae]", r"perdón\b", r"el texto no (?:dice|indica|contiene|menciona)\b.{0,60}(?:respuesta|responder|información)", r"no (?:tengo|dispongo de) (?:suficiente |bastante )?información",
        r"es tut mir (?:sehr )?leid", r"(?:tut mir|leider|bedaure|bedauerlicherweise|entschuldigung|verzeihung)\b.{0,80}(?:nicht|kein|leid)", r"(?:dazu|dabei|das|darauf|hierzu|hierbei|diese frage|damit) (?:kann|darf|möchte) ich\b", r"ich (?:kann|darf|möchte|bin)\b.{0,60}(?:nicht|keine?|leider|außerstande)", r"als (?:ki|sprachmodell|assistent)", r"der text (?:sagt|enthält|nennt)\b.{0,40}(?:nicht|keine)",
        r"(?:je suis |nous sommes )?(?:désolée?s?|navrée?s?)\b", r"je (?:suis (?:vraiment |sincèrement )?(?:désolé|navré|dans l'impossibilité|incapable)|ne (?:peux|puis|suis|saurais|dispose|sais)|regrette|refuse|dois (?:refuser|décliner))", r"(?:malheureusement|hélas)\b.{0,60}(?:pas|impossible|peux)", r"il (?:m'est|ne m'est pas|nous est) (?:impossible|possible|interdit)", r"en tant (?:que|qu')\s?(?:modèle|ia|assistant|intelligence)", r"(?:le texte|l'extrait) ne (?:dit|précise|contient|permet)",
        r"mi dispiace\b.{0,60}(?:non|impossibile)", r"(?:desculpe|lamento|sinto muito)\b", r"não posso\b", r"het spijt me\b", r"(?:к сожалению|извините|я не могу)", r"(?:抱歉|对不起|很遗憾|我(?:无法|不能)|作为(?:一个)?(?:人工智能|ai|语言模型))", r"(?:申し訳|すみません|残念ながら|お答えできません)", r"(?:عذرا|آسف|أعتذر|لا أستطيع|لا يمكنني)", r"(?:क्षमा करें|माफ़ कीजिए|मैं .{0,30}नहीं (?:दे|कर|बता) सकता)", r"(?:ขออภัย|ขอโทษ|ฉันไม่สามารถ)",
    ]) + ")"
)
# Names of languages, by which a prompt asks for another one.
ASKED = re.compile(
    r"\b(?:translat\w*|übersetz\w*|tradu[ciz]\w*|traduis\w*|english|spanish|german|french|italian|portuguese|dutch|russian|chinese|mandarin|japanese|arabic|hindi|thai|korean|"
    r"inglés|español|castellano|alemán|francés|italiano|englisch\w*|spanisch\w*|deutsch\w*|französisch\w*|anglais|espagnol|allemand|français)\b|перевед|на (?:русск|англ)|翻译|翻訳|译成|ترجم|अनुवाद|แปล"
)
LABEL = re.compile(r"(?:the )?(?:answer|response|reply|question|instruction|output|input|task|prompt|a|q|antwort|frage|aufgabe|respuesta|pregunta|réponse|question|consigne|instrucción)\s*(?:\d+\s*)?[:：.\-–—]\s*", re.I)
_FUNCTION_END = set(
    "the a an of to in on at by for with from and or but because that which who is are was were be been has have had it its this these not no more than as if when about into after before most "
    "de la el los las un una y o que en por con del al su se es para como pero porque lo "
    "der die das den dem des ein eine einer und oder von zu mit auf für ist im in am bei nach weil dass sich als wird wurde war vom zum zur "
    "le les des du et ou que qui dans pour par sur ne pas au aux son sa ses est a été puis sans selon pendant parce".split()
)
_ITEM = re.compile(r"\s*(?:[-*•‣–]|\(?(?:\d{1,3}|[a-z]|[ivx]{1,4})\)|\d{1,3}\.)\s+\S")
#: A reference in brackets after the last sentence.
REFERENCE = re.compile(r"([.!?…。！？।؟۔][\"'”’»)]*)\s*[(\[（][^()\[\]（）\n]{1,60}[)\]）]$")
_PAIRS = {"(": ")", "[": "]", "{": "}", "«": "»", "“": "”", "„": "“", "「": "」", "（": "）"}


_MARKS = re.compile(r"[\W_]+")


def _bare(text: str) -> str:
    """Letters and figures only, NFKC and case-folded."""
    return _MARKS.sub("", text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).casefold())


def _visible(text: str) -> str:
    return "".join(c for c in text if not (c.isspace() or unicodedata.category(c) in ("Cf", "Cc", "Zs", "Zl", "Zp")))


def is_empty(answer: str | None) -> bool:
    """Nothing but white space, marks or a placeholder."""
    if answer is None:
        return True
    low = " ".join(answer.lower().split())
    if not any(c.isalnum() for c in low):
        return True
    core = low.strip("\"'“”‘’«»()[]{}<>*_-–—.…?!:;,#/|\\` ​﻿")
    return core in PLACEHOLDERS or bool(re.fullmatch(r"x{2,}|[<\[{(]\s*[\w ]{2,30}\s*[>\]})]", low) and not re.search(r"\d", low) and low[:1] in "<[{")


def is_copy(prompt: str | None, answer: str) -> bool:
    """The answer is the prompt, once or several times, apart from case, punctuation, white space and a label, or four words or
    more of its beginning."""
    wanted = _bare(prompt or "")
    if len(wanted) < 4:
        return False
    # What is left when labels go can hold the prompt only if it is all in the answer, or its beginning in one that is hardly longer.
    whole = _bare(answer)
    if wanted not in whole and not (len(whole) < len(wanted) + 40 and wanted[:4] in whole):
        return False
    text = answer.strip(" \t\r\n\"'“”«»*_`>([{")
    for candidate in (text, LABEL.sub("", text, count=1), LABEL.sub("", text)):
        given = _bare(candidate)
        if given and len(given) % len(wanted) == 0 and given == wanted * (len(given) // len(wanted)):
            return True
        if len(candidate.split()) >= 4 and len(given) < len(wanted) and wanted.startswith(given):
            return True
    return False


def _opening(text: str) -> str:
    text = text.replace("’", "'").replace("‘", "'").lower().strip(" \t\r\n\"“”«»*_`>([{'¡¿-–—")
    return " ".join(LABEL.sub("", text, count=1).split())


def is_refusal(prompt: str | None, answer: str) -> bool:
    """The answer opens with a refusal; a repeated prompt or an opening label before it is skipped."""
    opening = _opening(answer)
    asked = _opening(prompt or "")
    if asked and opening.startswith(asked):
        opening = _opening(opening[len(asked) :])
    return bool(REFUSAL.match(opening))


def is_other_language(prompt: str | None, answer: str) -> bool:
    """The answer has clear evidence of a language for which the prompt has less than for its own, without asking for it."""
    if ASKED.search((prompt or "").lower()):
        return False
    asked = guess(prompt)
    if asked is None:
        return False
    found = scores(answer)
    given = max(sorted(found), key=found.__getitem__) if found else asked
    return given != asked and found[given] >= 2.5 and found[given] > 2 * found.get(asked, 0.0)


def is_truncated(answer: str) -> bool:
    """Running text that stops before its last sentence is complete; short answers and lists don't count as such."""
    text = answer.strip()
    text = re.sub(r"(?:\s*(?:\[\d+\]|\(\d+\)|\*\*|__|`+))+$", "", text).strip()
    text = REFERENCE.sub(r"\1", text)
    lines = [line for line in text.split("\n") if line.strip()]
    if not lines:
        return False
    listed = _ITEM.match(lines[-1]) and (len(lines) == 1 or _ITEM.match(lines[-2]))
    tail = text.rstrip("\"'”’»›」』）)]}*“")
    closed = tail[-1:] in tuple(".!?…。！？।؟۔")
    if listed:
        return bool(re.search(r"(?:[,(\[«“„]|\b(?:and|or|the|of|y|und|et))$", text))
    if re.search(r"(?:[(\[{«„“]|\((?:see|cf\.?|vgl\.?|voir|véase))\s*$", text) or text.endswith(' "'):
        return True
    if re.search(r"(?:…|\.\.\.)$", tail) and len(tail.split()) > 2:
        return True
    if closed:
        last = re.search(r"(\S+)[.]$", tail)
        if last and last[1].lower().strip("(\"'“«") in NEVER and len(tail.split()) > 3:
            return True
        for a, b in _PAIRS.items():  # an end mark inside what was opened and not closed
            if text.rfind(a) > text.rfind(b) and not (a == "“" and "„" in text) and not (a == "„" and "”" in text[text.rfind(a) :]):
                return True
        return text.count('"') % 2 == 1 and not text.startswith('"')
    if text.endswith((",", ";", " -", " –", "(", "—")) or re.search(r"\s[-–—]$", text):
        return True
    words = text.split()
    if len(sentence_spans(text)) > 1:
        return True
    if any(c > "⺀" for c in text) and len(words) <= 3:
        return len(_visible(text)) > 15
    lettered = [w for w in words if any(c.isalpha() for c in w)]
    plain = [w for w in lettered[1:] if w[:1].islower() and not any(c.isdigit() for c in w)]
    if text[:1].islower() or text[:1].isdigit():
        return len(words) >= 8 or len(words) >= 4 and words[-1].lower() in _FUNCTION_END
    return len(words) >= 5 and len(plain) >= 2 or len(words) >= 3 and words[-1].lower() in _FUNCTION_END


def defects(prompt: str | None, answer: str | None) -> list[str]:
    """Every defect type of the pair, in the order of DEFECTS; rules that need an answer's text don't run without it."""
    if is_empty(answer):
        return ["empty"]
    found = []
    if is_copy(prompt, answer):
        found.append("copy")
    if is_refusal(prompt, answer):
        found.append("refusal")
    if is_other_language(prompt, answer):
        found.append("language")
    if is_truncated(answer):
        found.append("truncated")
    return found


def pair_of(payload: str | None) -> tuple[str | None, str | None] | None:
    """(prompt, answer) of a JSON payload; null if it is no JSON object with a question or an instruction."""
    try:
        record = json.loads(payload) if payload else None
    except ValueError:
        return None
    if not isinstance(record, dict):
        return None
    key, value = ("question", "answer") if "question" in record else ("instruction", "output") if "instruction" in record or "output" in record else ("question", "answer")
    text = lambda x: x if isinstance(x, str) or x is None else json.dumps(x, ensure_ascii=False)
    return text(record.get(key)), text(record.get(value))


def defective_pairs(examples: DataFrame, *, id: str = "id", payload: str = "payload") -> DataFrame:
    """(id, defect, rank) of every defect type found; rank 0 is the first rule that applied.

    A payload that is null, no JSON object or without an answer is `empty`. Rows delivered twice count once; if rows of one id
    differ, each contributes and equal findings come out once. Rows of a null id are left out; other columns are ignored.
    """

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, body in zip(batch["id"], batch["payload"]):
                prompt, answer = pair_of(body) or (None, None)
                out += [(name, d, k) for k, d in enumerate(defects(prompt, answer))]
            yield pd.DataFrame(out, columns=["id", "defect", "rank"])

    rows = examples.select(F.col(id).cast("string").alias("id"), F.col(payload).cast("string").alias("payload")).where(F.col("id").isNotNull())
    return rows.mapInPandas(judge, "id string, defect string, rank int").distinct()
