"""Language of a text from its script and its most common words."""

from __future__ import annotations

import re

# Common function words of languages in Latin script.
COMMON = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all we can her has there been if more when will would who so no what up its about into than them only other time new some could these two may then do first any my now such like our over me even most made after also did many off must before back through years where much your way down should because long each just how under while same another and".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está mi porque qué sólo han yo hay vez puede todos así nos ni parte tiene él uno donde bien tiempo mismo ese ahora cada vida otro después te otros aunque esa eso hace otra gobierno tan durante siempre día tanto ella tres sí dijo sido gran según menos antes quién cuántos debe".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei hatte kann gegen vom können schon wenn habe seine ihre dann unter wir soll ich eines jahr zwei diese dieser wieder keine seiner worden will zwischen immer was sagte wer geben muss warum lange danach weil vom nur wegen".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont la aux avec son on cette ou ses comme mais nous sa tout fait été aussi leur bien peut ces y deux même ans entre ont si sous elle je lui vous ils où dont donc sans puis encore temps après très était quand ainsi être faire avant notre trop doit selon pendant combien pourquoi parce l'on qu'il d'un d'une n'est".split(),
    "it": "di e il la che in un a per è una sono con non del si da le al come più i gli ha ma lo dei alla nel della anche questo dal o se ci delle suo sua perché quando essere".split(),
    "pt": "de a o que e do da em um para é com não uma os no se na por mais as dos como mas foi ao ele das tem à seu sua ou ser quando muito há nos já está eu também só pelo pela até isso ela entre era depois sem mesmo aos".split(),
    "nl": "de het een en van in is dat op te zijn met voor niet aan er die om ook als dan maar bij of uit nog naar door over ze hij tot je mijn wordt worden deze dit heeft had werd kan".split(),
}
_WEIGHTS: dict[str, list[tuple[str, float]]] = {}
for _lang, _words in COMMON.items():
    for _w in set(_words):
        _WEIGHTS.setdefault(_w, []).append((_lang, 1.0))
_WEIGHTS = {w: [(x, 1.0 / len(v)) for x, _ in v] for w, v in _WEIGHTS.items()}
_LETTERS = {"es": "ñ¿¡", "de": "ßäöü„", "fr": "èêçœùîâô", "pt": "ãõ"}
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")

# Scripts by code point range, with the language taken for them.
_SCRIPTS = [
    (0x0400, 0x052F, "ru"), (0x0370, 0x03FF, "el"), (0x0530, 0x058F, "hy"), (0x0590, 0x05FF, "he"), (0x0600, 0x077F, "ar"), (0x0900, 0x097F, "hi"),
    (0x0980, 0x09FF, "bn"), (0x0A80, 0x0AFF, "gu"), (0x0B80, 0x0BFF, "ta"), (0x0C00, 0x0C7F, "te"), (0x0E00, 0x0E7F, "th"), (0x0E80, 0x0EFF, "lo"),
    (0x1000, 0x109F, "my"), (0x10A0, 0x10FF, "ka"), (0x1200, 0x137F, "am"), (0x1780, 0x17FF, "km"), (0x3040, 0x30FF, "ja"), (0x3400, 0x9FFF, "zh"), (0xAC00, 0xD7AF, "ko"),
]
_OTHER = re.compile(r"[\u0370-\u1cff\u3040-\ud7ff]+")


def _script(c: str) -> str | None:
    at = ord(c)
    return next((lang for a, b, lang in _SCRIPTS if a <= at <= b), None)


def scores(text: str) -> dict[str, float]:
    """Evidence for each language: letters of its script, or common words shared out among the languages that have them."""
    found: dict[str, float] = {}
    if not text.isascii():
        for run in _OTHER.findall(text):
            lang = "ja" if any("\u3040" <= c <= "\u30ff" for c in run) else _script(run[0])
            if lang:
                found[lang] = found.get(lang, 0.0) + len(run) / 3
        if "ja" in found and "zh" in found:
            found["ja"] += found.pop("zh")
    low = text.lower()
    for w in _WORD.findall(low):
        if w in _WEIGHTS:
            for lang, x in _WEIGHTS[w]:
                found[lang] = found.get(lang, 0.0) + x
        elif "'" in w or "’" in w:
            for part in set(re.split(r"['’]", w)):
                for lang, x in _WEIGHTS.get(part, ()):
                    found[lang] = found.get(lang, 0.0) + x
    if not text.isascii():
        for lang, letters in _LETTERS.items():
            if n := sum(low.count(c) for c in letters):
                found[lang] = found.get(lang, 0.0) + min(n, 4)
    return found


def guess(text: str | None, least: float = 1.0) -> str | None:
    """The language with most evidence, null if that is less than `least`; ties go to the first in alphabetical order."""
    found = scores(text) if text else {}
    if not found:
        return None
    best = max(sorted(found), key=found.__getitem__)
    return best if found[best] >= least else None
