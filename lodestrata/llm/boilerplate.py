"""Page furniture around and inside the main body, found with a suffix array over the page token streams of all hosts.

All pages form token streams in which figures, codes and links are masked and line ends are tokens. The array is built by prefix
doubling over hashed ranks: the rank of a suffix by its first OPENING, 2 * OPENING, 4 * OPENING ... tokens is the 64-bit hash
of these tokens, so suffixes of equal rank are one interval of the array, and only the ranks, counted in the tasks before
they move, are shuffled. Suffixes whose opening nobody shares drop out after the first step.

Every position of every stream takes part in the first step. It tells of each opening on how many pages of a host and of all hosts
a line starts with it, and how often it stands elsewhere. A run is furniture if lines on enough distinct pages start with it
(LEAST of one host, LEAST_ANYWHERE of all: small hosts have too few pages to show it) and if it nearly always starts a line, its left
context in the array: menus, notices and prompts are lines of their own, while phrases that body texts share stand anywhere
within them. The next steps, for lines that start with such a run, find how far the run goes on; a line of which most is
unique is kept. So no list of phrases decides: a line that recurs comes out whatever it says.

Structure settles the rest: titles, headings of sections, list items and table rows of the body recur as well and are kept; short
lines up to the next blank line belong to the link block of the furniture line above them; and what stands before the title needs only
an opening that one other page has, as does a line that reads like a notice (`notices`).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, skew_safe_lookup
from .furniture import SENTENCE_END, folded, furniture
from .shapes import cells

OPENING, LEAST, LEAST_ANYWHERE = 3, 3, 5
#: Share of an opening's occurrences that start a line; share of a line that its run has to cover.
ANCHORED, COVERED = 0.8, 1 / 3
#: Share of the lines with an opening that a run over half of the line has, for rows of cells.
FIXED = 0.5
#: Pages delivered twice are broadcast up to this many.
MOST_REPEATED = 200_000
#: Tokens that are ranked at once within a task.
AT_ONCE = 400_000
#: Pages whose lines are described at once.
PAGES = 256
_FIGURE = re.compile(r"[a-z]{0,2}-?\d[\d.,-]*")
_LINK = re.compile(r"https?://[^\s)]*")
_UNSPACED = re.compile(r"([฀-໿က-႟ក-៿぀-ヿ㐀-鿿])")
_MARKER = re.compile(r"(?:[-*•‣–—]|\(?(?:\d{1,3}|[a-z]|[ivx]{1,4})[.)])\s+(?=\S)")
_LINK_ITEM = re.compile(r"(?:\[[^\]]*\]\([^)]*\)|https?://\S+)$")
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: What is known of a line besides its ranks.
NOTICE, GAP, HEAD, BODY, HEADING, ITEM, LINKED, SHORT, ROW = (1 << k for k in range(9))
_LINES = "page string, lines array<struct<no:int,flags:int,n:int,opening:bigint,more:array<bigint>>>"


def tokens(lines: list[str]) -> list[list[str]]:
    """Masked tokens of each folded line; characters of scripts without spaces are tokens."""
    text = "\n".join(lines)
    text = _FIGURE.sub("0", _LINK.sub("link", text) if "://" in text else text)
    if not text.isascii():
        text = _UNSPACED.sub(r" \1 ", text)
    return [line.split(" ") if "  " not in line and line[:1] != " " and line[-1:] != " " else line.split() for line in text.split("\n")]


class Streams:
    """The token streams of some pages, ranked by their first OPENING * 2 ** k tokens."""

    def __init__(self) -> None:
        self._known: dict[str, int] = {"\n": 1}
        self.hashes: list[int] = []
        self.starts: list[int] = []  # of the lines
        self.lengths: list[int] = []
        self.pages: list[int] = []

    def _hash(self, token: str) -> int:
        found = self._known.get(token)
        if found is None:
            if len(self._known) > 1 << 20:
                self._known = {"\n": 1}
            found = self._known[token] = xxhash.xxh64_intdigest(token) | 2
        return found

    def add(self, page: int, lines: list[list[str]]) -> None:
        """The tokens of lines that are not blank."""
        known, slow = self._known, self._hash
        for line in lines:
            row = [known.get(t) or slow(t) for t in line]
            self.starts.append(len(self.hashes))
            self.lengths.append(len(row) + 1)
            self.pages.append(page)
            self.hashes += row
            self.hashes.append(1)
        self.hashes += range(3 + 2 * OPENING * page, 3 + 2 * OPENING * (page + 1))  # no run goes beyond a page

    def ranks(self) -> Iterator[tuple[int, np.ndarray]]:
        """(tokens, rank of each position by as many tokens), doubled as long as asked."""
        n = OPENING
        h = np.array(self.hashes, np.uint64)
        rank = h.copy()
        with np.errstate(over="ignore"):
            for k in range(1, n):
                rank = rank * _BASE + np.append(h[k:], np.zeros(k, np.uint64))
            # A line of fewer tokens is ranked by itself: what follows it doesn't matter.
            short = np.array([(s, k) for s, k in zip(self.starts, self.lengths) if k < n], np.int64).reshape(-1, 2)
            whole = rank.copy()
            whole[short[:, 0]] = h[short[:, 0]] * _BASE + (short[:, 1] > 1)
            yield n, _mixed(whole)
            while True:
                if n > OPENING:
                    yield n, _mixed(rank)
                step = np.uint64(pow(int(_BASE), n, 1 << 64))
                rank = rank * step + np.append(rank[n:], np.zeros(min(n, len(rank)), np.uint64))
                n *= 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _page_lines(text: str) -> tuple[list[int], list[str], list[list[str]]]:
    """Numbers of the lines that are not blank, folded lines, and their tokens."""
    lines = [(i, f) for i, line in enumerate(text.split("\n")) if (f := folded(line))]
    texts = [f for _, f in lines]
    return [i for i, _ in lines], texts, tokens(texts) if texts else []


def _openings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, rank, pages, starts, inside) of the openings: rows with a host count lines, those without other positions."""

    def flush(streams: Streams, hosts: list[int], weights: list[float]) -> Iterator[pd.DataFrame]:
        if not streams.starts:
            return
        _, rank = next(streams.ranks())
        starts, page = np.array(streams.starts), np.array(streams.pages)
        weight, host = np.array(weights), np.array(hosts, np.int64)
        seen = pd.DataFrame({"host": host[page], "page": page, "rank": rank[starts], "starts": weight[page]})
        # Within a page a rank counts once; pages are weighed by the inverse of how often they were delivered.
        seen = seen.groupby(["host", "page", "rank"], sort=False, as_index=False)["starts"].sum()
        seen["pages"] = weight[seen["page"].to_numpy()]
        seen = seen.groupby(["host", "rank"], sort=False, as_index=False)[["pages", "starts"]].sum()
        yield seen.assign(inside=0.0)[["host", "rank", "pages", "starts", "inside"]]
        inside = np.ones(len(rank), bool)
        inside[starts] = False
        span = np.repeat(np.arange(len(hosts)), streams.sizes)
        grams, where = np.unique(rank[inside], return_inverse=True)
        yield pd.DataFrame({"host": pd.array([None] * len(grams), "Int64"), "rank": grams, "pages": 0.0, "starts": 0.0, "inside": np.bincount(where, weight[span[inside]], len(grams))})

    streams, hosts, weights = Streams(), [], []
    streams.sizes = []
    for batch in batches:
        for host, body, weight in zip(batch["host"], batch["text"], batch["weight"]):
            before = len(streams.hashes)
            streams.add(len(hosts), _page_lines(body)[2])
            streams.sizes.append(len(streams.hashes) - before)
            hosts.append(host)
            weights.append(weight)
            if len(streams.hashes) >= AT_ONCE:
                yield from flush(streams, hosts, weights)
                streams, hosts, weights = Streams(), [], []
                streams.sizes = []
    yield from flush(streams, hosts, weights)


def _flags(raw: list[str], numbers: list[int], texts: list[str], words: list[list[str]], title: str | None, headings: list[str | None] | None, notices: bool) -> list[int]:
    heads = {folded(h).lstrip("# ") for h in [title, *([] if headings is None else headings)] if h}
    first = next((k for k, t in enumerate(texts) if t.startswith("#") or t in heads), 0)
    titled = title and any(t.lstrip("# ") == folded(title).lstrip("# ") for t in texts)
    marked: set[int] = set()
    if notices:
        every = [""] * len(raw)
        for i, t in zip(numbers, texts):
            every[i] = t
        marked = furniture(raw, title, texts=every)
    flags = []
    for k, (i, t) in enumerate(zip(numbers, texts)):
        f = NOTICE * (i in marked) | GAP * (not k or numbers[k - 1] != i - 1) | HEAD * (k < first)
        if t.lstrip("# ") in heads or t.startswith("# "):
            f |= BODY
        elif t.startswith("#"):
            f |= HEADING
        m = _MARKER.match(t)
        if m or t.startswith("["):
            f |= LINKED if _LINK_ITEM.search(t) else ITEM * bool(m and t.count(" * ") < 1)
        elif len(t) <= 60 and not SENTENCE_END.search(t):
            f |= SHORT
        if not f & (NOTICE | HEAD | BODY | LINKED) and is_row(raw[i], t, words[k]):
            f |= ROW
        flags.append(f)
    if not titled and first and not texts[first].startswith("# ") and flags[first] & flags[first - 1] & GAP:
        flags[first - 1] = flags[first - 1] & ~HEAD | BODY  # a line alone before the first heading is the title
    return flags


def is_row(raw: str, line: str, words: list[str]) -> bool:
    """Whether the line is a row of cells or of items, or letters set apart, rather than text."""
    if SENTENCE_END.search(line) and len(line) > 60:
        return False
    lettered = sum(w[0].isalpha() or w[0] in "(\"'[§#©" for w in words)
    return 2 * lettered <= len(words) or ";" in line[:-1] or line.isascii() and len(line) < 2.5 * len(words) or cells(raw) > 1


def decide(lines: list[tuple[int, int, int]]) -> list[int]:
    """Numbers of the lines of a page that are furniture; of each line its number, its flags and what the array says: 0 opening
    unique, 1 opening on another page too, 2 furniture run, but most of the line unique, 3 furniture run that covers the
    line, 4 the same and what follows its opening is nearly always the same."""
    found: list[int] = []
    lines = sorted(lines)
    edges = [k for k, (_, flags, _) in enumerate(lines) if flags & GAP] + [len(lines)]
    for a, b in zip(edges, edges[1:]):
        rest = lines[a + 1 : b]
        linked = sum(level >= 3 + bool(flags & ROW) or bool(flags & (LINKED | NOTICE)) for _, flags, level in rest)
        if lines[a][1] & (BODY | HEADING) and not lines[a][1] & HEAD and rest and 2 * linked >= len(rest) and all(flags & (SHORT | LINKED | ROW) and not flags & ITEM for _, flags, _ in rest):
            found += [no for no, _, _ in lines[a:b]]  # a heading over links
            continue
        block = False
        for no, flags, level in lines[a:b]:
            if flags & NOTICE and level:
                found.append(no)
                block = bool(flags & (SHORT | HEADING))
            elif flags & BODY:
                block = False
            elif flags & HEAD:
                if level:
                    found.append(no)
            elif flags & LINKED:
                if level or block:
                    found.append(no)
            elif flags & HEADING:
                block = level >= 3
                if block:
                    found.append(no)
            elif flags & ITEM:
                if block:
                    found.append(no)
            elif level >= 3 + bool(flags & ROW):
                found.append(no)
                block = block or bool(flags & SHORT)
            elif block and flags & SHORT and not flags & ROW:
                found.append(no)
            else:
                block = False
    return found


def furniture_lines(pages: DataFrame, *, page: str = "parsed_id", host: str = "source_id", text: str = "text", title: str | None = "title", sections: str | None = "sections", notices: bool = True) -> DataFrame:
    """(page, line_no) of the lines that are page furniture; line_no counts the text's lines from 0, blank ones included.

    Pages delivered twice count once. Null texts have no lines, pages of a null host form a host of their own, null pages are
    left out; null titles, sections and headings only mean that the head and the headings of the page are not told by them. Without
    `notices` no phrase list is asked. Other columns are ignored.
    """
    named = {"page": F.col(page).cast("string"), "host": F.xxhash64(F.coalesce(F.col(host).cast("string"), F.lit(""))), "text": F.col(text)}
    slim = pages.select(*[c.alias(k) for k, c in named.items()]).where(F.col("text").isNotNull() & F.col("page").isNotNull())
    repeated = cut(slim.groupBy("page").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1))
    repeated = F.broadcast(repeated) if repeated.count() <= MOST_REPEATED else repeated
    weighed = slim.join(repeated, "page", "left").select("host", "text", (1 / F.coalesce("_n", F.lit(1))).alias("weight"))
    counted = weighed.mapInPandas(_openings, "host bigint, rank bigint, pages double, starts double, inside double")
    counted = counted.groupBy("host", "rank").agg(*[F.sum(c).alias(c) for c in ("pages", "starts", "inside")])
    openings = counted.groupBy("rank").agg(F.sum("pages").alias("everywhere"), F.max("pages").alias("most"), F.sum("starts").alias("starts"), F.sum("inside").alias("inside"))
    enough = (F.col("most") > LEAST - 0.5) | (F.col("everywhere") > LEAST_ANYWHERE - 0.5)
    run = enough & (F.col("starts") >= ANCHORED * (F.col("starts") + F.col("inside")))
    openings = cut(openings.where(F.col("everywhere") > 1.5).select(F.col("rank").alias("opening"), run.alias("run"), "starts"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (whole.iloc[at : at + PAGES] for whole in batches for at in range(0, len(whole), PAGES)):
            streams, every = Streams(), []
            for k, (body, head, headings) in enumerate(zip(batch["text"], batch["title"], batch["headings"])):
                numbers, texts, words = _page_lines(body)
                streams.add(k, words)
                every.append((numbers, _flags(body.split("\n"), numbers, texts, words, head, headings, notices)))
            starts, lengths = np.array(streams.starts, np.int64), np.array(streams.lengths, np.int64)
            steps: list[list[int]] = [[] for _ in starts]
            for n, rank in streams.ranks():
                on = np.flatnonzero(lengths >= n) if n > OPENING else np.arange(len(starts))
                for k, r in zip(on.tolist(), rank[starts[on]].tolist()):
                    steps[k].append(r)
                if not len(on) or not (lengths >= 2 * n).any():
                    break
            at, out = 0, []
            for numbers, flags in every:
                out.append([{"no": i, "flags": f, "n": n, "opening": s[0], "more": s[1:]} for i, f, n, s in zip(numbers, flags, lengths[at : at + len(numbers)].tolist(), steps[at : at + len(numbers)])])
                at += len(numbers)
            yield pd.DataFrame({"page": batch["page"], "lines": out})

    known = F.transform(F.col(sections), lambda s: s["heading"]) if sections else F.lit(None).cast("array<string>")
    texts = pages.select(*[c.alias(k) for k, c in named.items() if k != "host"], (F.col(title) if title else F.lit(None)).cast("string").alias("title"), known.alias("headings"))
    rows = texts.where(F.col("text").isNotNull() & F.col("page").isNotNull()).mapInPandas(read, _LINES)
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    lines = rows.select("row", F.explode("lines").alias("line")).select("row", "line.*")
    total = lines.count()
    ranked = cut(skew_safe_lookup(lines, openings.withColumn("_k", F.col("starts")), ["opening"], "_k", total))
    # The later steps: how many distinct pages share the first 2, 4, 8 ... times OPENING tokens of lines that start with a run.
    reach = ranked.where("run").select("row", "no", "n", F.posexplode("more").alias("step", "rank"))
    shared = reach.groupBy("rank").agg(F.countDistinct("row").alias("pages"), F.count(F.lit(1)).alias("_k")).where(F.col("pages") > 1)
    long = skew_safe_lookup(reach, cut(shared), ["rank"], "_k", total).groupBy("row", "no").agg(F.max(F.struct("step", "pages")).alias("far"))
    runs = ranked.select("row", "no", "n", "run", "starts").join(long, ["row", "no"], "left")
    length = F.lit(OPENING) * F.pow(F.lit(2.0), F.coalesce(F.col("far.step") + 1, F.lit(0)))
    fixed = (2 * length > F.col("n")) & (F.col("far.pages") >= FIXED * F.col("starts"))
    level = F.when(~F.col("run") | (F.col("n") < OPENING), 1).when(length < F.col("n") * F.lit(COVERED), 2).when(fixed, 4).otherwise(3)
    told = runs.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("no", level.alias("level")))).alias("levels"))  # lines of one page
    told = told.join(rows.select("row", "page", F.transform("lines", lambda x: F.struct(x["no"].alias("no"), x["flags"].alias("flags"))).alias("lines")), "row")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, levels, lines in zip(batch["page"], batch["levels"], batch["lines"]):
                levels = dict(levels)
                out += [(name, no) for no in decide([(x["no"], x["flags"], levels.get(x["no"], 0)) for x in lines])]
            yield pd.DataFrame(out, columns=["page", "line_no"])

    return told.select("page", "levels", "lines").mapInPandas(judge, "page string, line_no int").distinct()


def main_body(pages: DataFrame, *, page: str = "parsed_id", host: str = "source_id", text: str = "text", title: str | None = "title", sections: str | None = "sections") -> DataFrame:
    """(page, body, removed) of every page: its text without the furniture lines, runs of blank lines kept as one.

    Pages of null text have an empty body. Pages delivered twice come out once.
    """
    gone = furniture_lines(pages, page=page, host=host, text=text, title=title, sections=sections).groupBy("page").agg(F.collect_set("line_no").alias("gone"))  # lines of one page
    texts = pages.select(F.col(page).cast("string").alias("page"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(F.col("page").isNotNull()).dropDuplicates(["page"])
    lines = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    body = F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), r"\n(?:[^\S\n]*\n){2,}", "\n\n"), r"^\s+|\s+$", "")
    return texts.join(gone, "page", "left").select("page", body.alias("body"), F.coalesce(F.size("gone"), F.lit(0)).alias("removed"))
