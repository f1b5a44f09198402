"""Words as compared by the leak and quality operators."""

from __future__ import annotations

import re
import unicodedata

WORD = re.compile(r"[^\W_]+")


def folded(text: str) -> str:
    """NFKC, then lower case."""
    if not text.isascii() and not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return text.lower()


def words(text: str | None) -> list[str]:
    """Maximal runs of letters or digits of the folded text; none of null."""
    return WORD.findall(folded(text)) if text else []
