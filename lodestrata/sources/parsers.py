"""Raw bytes to text and sections: HTML, JSON, XML, Markdown, CSV, with a chain that falls back."""

from __future__ import annotations

import csv
import io
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SECTION = "struct<heading:string,section_path:string,page:int,text:string,is_table:boolean>"
PARSED = f"text string, title string, sections array<{SECTION}>, parser string, score double, error string"
Section = tuple[str | None, str, int | None, str, bool]

_SILENT = {"script", "style", "noscript", "template", "nav", "svg"}
_BLOCKS = {"p", "div", "li", "tr", "section", "article", "br", "ul", "ol", "table", "pre", "blockquote", "header", "footer", "main"}


class _Reader(HTMLParser):
    """Collects headings, text and table rows in order; what is inside silent elements is skipped."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.parts, self.silent, self.heading = "", [], 0, None
        self.in_title, self.cells = False, None

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.silent += 1
        elif tag == "title":
            self.in_title = True
        elif re.fullmatch("h[1-6]", tag):
            self.heading = []
        elif tag == "tr":
            self.cells = []
        elif tag in ("td", "th") and self.cells is not None:
            self.cells.append("")
        elif tag in _BLOCKS:
            self.parts.append(("text", "\n"))

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag == "title":
            self.in_title = False
        elif re.fullmatch("h[1-6]", tag) and self.heading is not None:
            self.parts.append(("heading", " ".join("".join(self.heading).split())))
            self.heading = None
        elif tag == "tr" and self.cells is not None:
            self.parts.append(("row", " | ".join(" ".join(c.split()) for c in self.cells)))
            self.cells = None
        elif tag in _BLOCKS:
            self.parts.append(("text", "\n"))

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif self.silent:
            return
        elif self.heading is not None:
            self.heading.append(data)
        elif self.cells:
            self.cells[-1] += data
        else:
            self.parts.append(("text", data))


def _tidy(text: str) -> str:
    lines = [" ".join(line.split()) for line in text.split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def parse_html(raw: str) -> tuple[str, str | None, list[Section]]:
    """Text, title and sections; a heading opens a section, text before the first one has none but stays in the text."""
    reader = _Reader()
    reader.feed(raw)
    reader.close()
    sections: list[Section] = []
    whole, heading, body, rows = [], None, [], []

    def flush() -> None:
        if heading is not None:
            text = _tidy("".join(body))
            if rows:
                sections.append((heading, f"§{len(sections) + 1}", None, "\n".join(rows), True))
            if text or not rows:
                sections.append((heading, f"§{len(sections) + 1}", None, text, False))

    for kind, data in reader.parts:
        if kind == "heading":
            flush()
            heading, body, rows = data, [], []
            whole.append(f"\n{data}\n")
        elif kind == "row":
            rows.append(data)
            whole.append(f"{data}\n")
        else:
            body.append(data)
            whole.append(data)
    flush()
    return _tidy("".join(whole)), reader.title.strip() or None, sections


def string_leaves(value: object) -> list[str]:
    """Non-blank strings of a JSON value in document order; keys, numbers and booleans are skipped."""
    if isinstance(value, str):
        return [value] if value.strip() else []
    if isinstance(value, list):
        return [s for v in value for s in string_leaves(v)]
    if isinstance(value, dict):
        return [s for v in value.values() for s in string_leaves(v)]
    return []


def parse_json(raw: str) -> tuple[str, str | None, list[Section]]:
    text = "\n".join(string_leaves(json.loads(raw)))
    return text, None, [(None, "§1", 1, text, False)] if text else []


def parse_xml(raw: str) -> tuple[str, str | None, list[Section]]:
    """Texts and tails depth first, stripped. Declarations of entities are refused."""
    if "<!ENTITY" in raw:
        raise ValueError("entity declarations are refused")
    found = [s.strip() for s in ET.fromstring(raw).itertext() if s.strip()]
    return "\n".join(found), None, [(None, "§1", 1, "\n".join(found), False)] if found else []


def parse_markdown(raw: str) -> tuple[str, str | None, list[Section]]:
    sections: list[Section] = []
    parts = re.split(r"(?m)^(#{1,6})\s+(.+?)\s*$", raw)
    counters: list[int] = []
    for level, heading, body in zip(parts[1::3], parts[2::3], parts[3::3]):
        counters = counters[: len(level)] + [0] * (len(level) - len(counters))
        counters[-1] += 1
        path = "§" + ".".join(str(c or 1) for c in counters)
        lines = [x for x in body.strip().split("\n") if x.strip()]
        sections.append((heading, path, None, body.strip(), bool(lines) and all(x.lstrip().startswith("|") for x in lines)))
    return raw.strip(), sections[0][0] if sections else None, sections


def parse_csv(raw: str) -> tuple[str, str | None, list[Section]]:
    rows = [" | ".join(r) for r in csv.reader(io.StringIO(raw)) if any(c.strip() for c in r)]
    text = "\n".join(rows)
    return text, None, [(None, "§1", 1, text, True)] if rows else []


PARSERS: dict[str, Callable[[str], tuple[str, str | None, list[Section]]]] = {"text/html": parse_html, "application/json": parse_json, "application/xml": parse_xml, "text/xml": parse_xml, "text/markdown": parse_markdown, "text/csv": parse_csv}


def quality(text: str, sections: list[Section]) -> float:
    if not text and not sections:
        return 0.0
    bad = min(100 * text.count("�") / len(text), 1.0) if text else 0.0
    empty = 1 - sum(not s[3].strip() for s in sections) / len(sections) if sections else 0.5
    return 0.35 * min(len(text) / 200, 1) + 0.2 * min(len(sections) / 3, 1) + 0.25 * (1 - bad) + 0.2 * empty


def parse(raw: str | None, mime: str | None, least: float = 0.4) -> tuple:
    """The first parser of the chain (by type, then plain text) whose result scores `least`; else an error."""
    mime = (mime or "").split(";")[0].strip().lower()
    chain = [(mime, PARSERS[mime])] if mime in PARSERS else []
    chain.append(("text/plain", lambda x: (x.strip(), None, [(None, "§1", 1, x.strip(), False)] if x.strip() else [])))
    error = "empty"
    for name, parser in chain if raw else []:
        try:
            text, title, sections = parser(raw)
        except Exception as e:  # a parser that fails makes way for the next
            error = type(e).__name__
            continue
        score = quality(text, sections)
        if score >= least:
            return text, title, sections, name, round(score, 6), None
        error = "low_score"
    return None, None, None, None, None, error


def parse_documents(raw: DataFrame, *, id: str, content: str, mime: str) -> DataFrame:
    """(id, text, title, sections, parser, score, error) of raw documents; error is null where a parser succeeded."""
    kind = dict(raw.dtypes)[id]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [parse(c.decode("utf-8", "replace") if isinstance(c, (bytes, bytearray)) else c, m) for c, m in zip(batch["content"], batch["mime"])]
            keys = ("heading", "section_path", "page", "text", "is_table")
            frame = pd.DataFrame(out, columns=["text", "title", "sections", "parser", "score", "error"])
            frame["sections"] = [[dict(zip(keys, s)) for s in x] if x is not None else None for x in frame["sections"]]
            frame.insert(0, "id", batch["id"].to_numpy())
            yield frame

    return raw.select(F.col(id).alias("id"), F.col(content).alias("content"), F.col(mime).alias("mime")).mapInPandas(run, f"id {kind}, {PARSED}").withColumnRenamed("id", id)
