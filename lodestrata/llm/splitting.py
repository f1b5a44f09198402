"""Oversized texts cut into pieces at natural boundaries: structure-tree packing.

A text is parsed into a tree: a markdown heading holds what follows it down to the next heading of its level or above, deeper
headings among it; what is between headings falls into blocks parted by blank lines; a block with list items into the items, each
with its continuation lines and the deeper items below it. A heading has no node of its own but belongs to the first node under
it, so no piece ends with a heading. Plain text falls into lines, sentences, clauses and words. Bottom-up, sibling subtrees are
merged as long as they fit, also with what is left of a sibling that had to be cut; only nodes over the limit are descended into, and a
single word over the limit is cut by length. Pieces are substrings of the text: the overlap is the text before the piece,
reaching back at most `overlap` characters and starting at a natural boundary.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 1500, 150

#: Plain text of each depth is cut after these.
BOUNDARIES = [
    re.compile(r"\n+"),
    re.compile(r"""[.!?…]["'”’»)\]]*\s+|[。！？।؟۔]["'”’»」』）)]*\s*"""),
    re.compile(r"[;,:，；、،]\s*|\s[–—]\s"),
    re.compile(r"\s+"),
]
_HEADING = re.compile(r"^(#{1,6})[ \t]", re.M)
_BLANK = re.compile(r"\n[ \t\r\f\v]*\n\s*")
_ITEM = re.compile(r"^([ \t]*)(?:[-*+•‣–]|\(?(?:\d{1,3}|[a-zA-Z]|[ivx]{1,4})[.)])[ \t]+(?=\S)", re.M)
#: A node is its span and its children, which cover the span; without children it is plain text.
Node = tuple[int, int, list]


def _nested(start: int, end: int, marks: list[tuple[int, int]], plain: Callable[[int, int], list[Node]]) -> list[Node]:
    """Nodes of [start, end): marks are (position, depth) of what begins there and holds deeper marks below it."""
    nodes = plain(start, marks[0][0]) if marks and marks[0][0] > start else [] if marks else plain(start, end)
    k = 0
    while k < len(marks):
        at, depth = marks[k]
        after = next((n for n in range(k + 1, len(marks)) if marks[n][1] <= depth), len(marks))
        stop = marks[after][0] if after < len(marks) else end
        nodes.append((at, stop, _nested(at, stop, marks[k + 1 : after], plain)))
        k = after
    return nodes


def _blocks(text: str, start: int, end: int) -> list[Node]:
    edges = [start, *[m.end() for m in _BLANK.finditer(text, start, end) if start < m.end() < end], end]
    nodes = []
    for a, b in zip(edges[:-1], edges[1:]):
        # Depth of an item is its indentation.
        items = [(m.start(), len(m[1].expandtabs(4))) for m in _ITEM.finditer(text, a, b)]
        nodes.append((a, b, _nested(a, b, items, lambda x, y: [(x, y, [])]) if items else []))
    return nodes


def _from(node: Node, start: int) -> Node:
    """The node, and with it the first of its children, from an earlier start."""
    _, end, children = node
    return start, end, [_from(children[0], start), *children[1:]] if children else []


def tree(text: str) -> Node:
    headings = [(m.start(), len(m[1])) for m in _HEADING.finditer(text)]
    starts = {at for at, _ in headings}

    def plain(a: int, b: int) -> list[Node]:
        if a not in starts:
            return _blocks(text, a, b)
        # The heading goes with the first block under it.
        line = text.find("\n", a, b) + 1
        below = line + len(text[line:b]) - len(text[line:b].lstrip()) if line else b
        if below >= b:
            return [(a, b, [])]
        first, *rest = _blocks(text, below, b)
        return [_from(first, a), *rest]

    return 0, len(text), _nested(0, len(text), headings, plain)


def _merged(spans: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    merged = spans[:1]
    for a, b in spans[1:]:
        if b - merged[-1][0] <= limit:
            merged[-1] = (merged[-1][0], b)
        else:
            merged.append((a, b))
    return merged


def _plain(text: str, start: int, end: int, depth: int, limit: int) -> list[tuple[int, int]]:
    if end - start <= limit:
        return [(start, end)]
    if depth == len(BOUNDARIES):
        return [(i, min(i + limit, end)) for i in range(start, end, limit)]
    edges = [start, *[m.end() for m in BOUNDARIES[depth].finditer(text, start, end) if start < m.end() < end], end]
    if len(edges) > 2 and depth == 0 and _HEADING.match(text, start):
        edges.pop(1)  # the heading stays with what follows it
    return _merged([s for a, b in zip(edges[:-1], edges[1:]) for s in _plain(text, a, b, depth + 1, limit)], limit)


def _pack(text: str, node: Node, limit: int) -> list[tuple[int, int]]:
    """Spans of at most `limit` that follow each other from the node's start to its end."""
    start, end, children = node
    if end - start <= limit:
        return [(start, end)]
    if not children:
        return _plain(text, start, end, 0, limit)
    return _merged([s for child in children for s in _pack(text, child, limit)], limit)


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(from, own, to): the piece is text[from:to], of which text[from:own] repeats the end of the piece before."""
    if len(text) <= limit:
        return [(0, 0, len(text))]
    overlap = min(overlap, limit // 2)
    spans = _pack(text, tree(text), limit - overlap)
    result = []
    for k, (a, b) in enumerate(spans):
        first = a
        if k:
            reach = max(a - overlap, spans[k - 1][0])
            # Back to the earliest sentence or else word boundary within reach; in unspaced scripts as far as allowed.
            for depth in (1, 3):
                if hit := next((m.end() for m in BOUNDARIES[depth].finditer(text, reach, a) if m.end() < a), None):
                    first = hit
                    break
            else:
                first = reach
        result.append((first, a, b))
    return result


def split_sections(docs: DataFrame, *, doc: str = "parsed_id", sections: str = "sections", limit: int = LIMIT, overlap: int = OVERLAP, deduplicate: bool = True) -> DataFrame:
    """(doc, section_no, piece_no, start_char, text, overlap_chars, section_path, n_pieces, is_table) of all sections.

    Sections of at most `limit` code points and tables stay whole (a table may exceed the limit: it has no inner boundary to
    be cut at without losing its header); a null text counts as empty. Offsets are code points; without their overlap the
    pieces of a section join to its text exactly. A null is_table is no table. Documents delivered twice come out once,
    unless deduplicate is false, which saves shuffling the texts where the caller reduces to keys anyway.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be less than limit")
    rows = docs.select(F.col(doc).cast("string").alias("doc"), F.posexplode(sections).alias("section_no", "s"))
    rows = rows.select("doc", "section_no", F.coalesce("s.text", F.lit("")).alias("text"), F.col("s.section_path").alias("section_path"), F.coalesce("s.is_table", F.lit(False)).alias("is_table"))
    big = (F.char_length("text") > limit) & ~F.col("is_table")
    whole = rows.where(~big).select("doc", "section_no", F.lit(0).alias("piece_no"), F.lit(0).cast("bigint").alias("start_char"), "text", F.lit(0).alias("overlap_chars"), "section_path", F.lit(1).alias("n_pieces"), "is_table")

    names = whole.columns

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, no, text, path in zip(batch["doc"], batch["section_no"], batch["text"], batch["section_path"]):
                spans = pieces(text, limit, overlap)
                out += [(name, no, k, first, text[first:b], a - first, path, len(spans), False) for k, (first, a, b) in enumerate(spans)]
            yield pd.DataFrame(out, columns=names)

    cut = rows.where(big).select("doc", "section_no", "text", "section_path").mapInPandas(cut_up, whole.schema)
    every = whole.unionByName(cut)
    return every.dropDuplicates(["doc", "section_no", "piece_no"]) if deduplicate else every
