"""Token-bounded chunks of documents with overlapping sentences."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPLIT = re.compile(r"(?<=[.!?])\s+(?=[A-Z])")
_TOKEN = re.compile(r"[^\W\d_]+|\d{1,3}|[^\w\s]+|_+")


def tokens(text: str) -> int:
    return len(_TOKEN.findall(text))


def pack_sentences(text: str, most: int = 512, overlap: int = 64) -> list[str]:
    """Sentences packed up to `most` tokens; a chunk opens with the last sentences of the one before that together fit
    into `overlap` tokens, and holds at least one new sentence, however long.

    A chunk is a range of sentences. With the running token totals its end and its opening are found by bisection.
    """
    sentences = [s.strip() for s in _SPLIT.split(text.strip()) if s.strip()]
    upto = list(accumulate(map(tokens, sentences), initial=0))
    chunks, start, fresh = [], 0, 0
    while fresh < len(sentences):
        end = max(fresh + 1, bisect_right(upto, upto[start] + most, fresh) - 1)
        chunks.append(" ".join(sentences[start:end]))
        start, fresh = bisect_left(upto, upto[end] - overlap, start, end), end
    return chunks


def chunk_sections(docs: DataFrame, *, doc: str = "parsed_id", sections: str = "sections", most: int = 512, overlap: int = 64) -> DataFrame:
    """(doc, ord, section_path, page, text, is_table, oversized) of all sections: heading, blank line, body.

    Tables are one chunk however large. section_path gets a suffix .i only where a section has several chunks. Sections
    without any text but a heading give no chunk. A null path counts as the section's number. A document without sections is one
    section §1 on page 1 with all of its text, if docs has a column `text`.
    """
    parts = F.col(sections)
    if "text" in docs.columns:
        kinds = docs.schema[sections].dataType.elementType
        named = {"section_path": F.lit("§1"), "page": F.lit(1), "text": F.col("text"), "is_table": F.lit(False)}
        whole = F.array(F.struct(*[named.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds.fields]))
        parts = F.when(F.coalesce(F.size(parts), F.lit(0)) <= 0, whole).otherwise(parts)
    rows = docs.select(F.col(doc).alias("doc"), F.posexplode(parts).alias("no", "s")).select("doc", "no", "s.*")
    kind = dict(docs.dtypes)[doc]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for d, no, heading, path, page, text, table in zip(*[batch[c] for c in ("doc", "no", "heading", "section_path", "page", "text", "is_table")]):
                if not (text or "").strip():
                    continue
                body = f"{heading}\n\n{text}" if heading else text
                parts = [body] if table is True else pack_sentences(body, most, overlap)
                base = path or f"§{no + 1}"
                out += [(d, no, i, f"{base}.{i + 1}" if len(parts) > 1 else base, page, p, table is True, tokens(p) > most) for i, p in enumerate(parts)]
            frame = pd.DataFrame(out, columns=["doc", "section_no", "part", "section_path", "page", "text", "is_table", "oversized"])
            yield frame.astype({"page": "Int32"})

    return rows.mapInPandas(build, f"doc {kind}, section_no int, part int, section_path string, page int, text string, is_table boolean, oversized boolean")
