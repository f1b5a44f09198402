"""What a line of a page looks like: furniture such as menus and notices, or body. Pure functions on one page."""

from __future__ import annotations

import re

_GAP = re.compile(r"[\s  -​  　﻿]+")
SENTENCE_END = re.compile(r"[.!?…。！？।؟۔։።။។]['\"”’»›」』）)\]]*$")
_MONTH = r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"

# Phrases of page furniture, matched from the start of the folded line.
_PATTERNS = [
    # menus, breadcrumbs, skip links, search boxes
    r"skip (?:to|navigation)\b", r"jump to (?:content|navigation)", r"(?:zum inhalt|aller au contenu|saltar al contenido|ir al contenido)",
    r"you are here\b", r"(?:home|start|startseite|inicio|accueil)\s*[>»/|›]", r"menu(?:\s+search|\s*[|]|$)", r"search (?:this|our|the) (?:site|library|page|catalog)", r"(?:site )?search(?:\s*\.\.\.|…|:)?$",
    r"language: ?[a-z]{2}\b", r"(?:languages?|idioma|sprache|langue)\s*:\s*\w+(?:\s*\|\s*\w+)+$", r"(?:\* ?\w+ ){2,}\* ?", r"(?:\[[^\]]+\]\([^)]*\)\s*){2,}$",
    r"(?:home|about(?: us)?|contact(?: us)?|news|jobs|careers|forms|library|log ?in|sign in|log ?out|register|help|faq|sitemap|site map|menu|search|events|media|topics|services|patients|providers|partners|publications|imprint|impressum|kontakt|contacto|back|next|previous|top|print|share|subscribe|login)$",
    # cookies and privacy choices
    r"(?:accept|allow|reject|manage|essential|alle|tous les)\b.{0,40}\bcookies?\b", r"(?:we|this (?:site|page|website)|our|usamos|utilizamos|este|esta|diese|wir|ce site|nous|by (?:browsing|using|continuing)|some features|your|мы)\b[^.;]{0,70}\b(?:cookies?|trackers?)\b(?! left)", r"(?:we|we and our).{0,30}\bstore data on your device", r".{0,40}(?:файлы cookie|cookie を|クッキーを使用|使用 ?cookie)",
    r"your privacy matters", r"cookie (?:settings|policy|notice|statement|preferences)",
    # share, feedback and subscription prompts
    r"share (?:this|on|via)\b", r"(?:tweet|pin it|email this|print this)\b", r"sign up (?:for|to)\b", r"subscribe (?:to|now|for)\b", r"follow us\b", r"like this (?:article|page|notice|post)\b", r"was this (?:page|article|answer) (?:helpful|useful)", r"tell us what you think", r"(?:rate|comment on) this (?:page|article)", r"(?:get|receive) (?:our|the) .{0,30}(?:newsletter|digest|updates)", r"join (?:our|the) .{0,40}(?:list|newsletter|community)",
    # bylines, contact
    r"(?:prepared|reviewed|written|edited|compiled|posted|published|approved) by (?:the )?.{0,60}\b(?:desk|panel|staff|team|editors?|board|committee|office|bureau|authority|council|registry|group)\b(?!.*[.]$)", r"by [a-z. ]{3,40} \| ", r"(?:last|page last) (?:updated|modified|reviewed|changed)\b", r"questions\? ", r"(?:for more information|enquiries|inquiries|press contact)[:,]? (?:contact|write|call|email)?", r"contact (?:us|the .{3,40} desk)\b", r".{0,60}\|\s*tel\.?\s*[\d+(]", r"(?:tel|phone|fax|e-?mail)\s*[.:]",
    # legal, trademark, printing and distribution notices
    r"(?:©|\(c\)|copyright)\s*(?:\d|by\b)", r".{0,80}\ball rights reserved", r"trademarks?\b.{0,60}\b(?:belong|are the property|owners?)\b", r".{0,60}\b(?:is|are) (?:a )?(?:registered )?trademarks? of\b", r"terms of (?:use|supply|service|sale)\b", r"(?:this|the) (?:bulletin|notice|page|document|publication|leaflet|website|site)\b.{0,80}\bfor information(?:al purposes)? only\b", r".{0,60}creates no rights for any person", r"the (?:content|contents|information) (?:of|on|in) this (?:library|site|website|page|portal)\b.{0,60}\bnot (?:replace|substitute|constitute)", r"reproduction (?:of|in)\b.{0,80}\b(?:requires|prohibited|permission|consent)", r"no part of this .{0,40}may be reproduced", r"printed copies are uncontrolled", r"uncontrolled (?:when|if) printed", r"distribution statement\b", r"approved for (?:public )?release", r"privacy(?: policy| notice)?\s*\|", r"(?:disclaimer|legal notice|privacy policy|accessibility statement)\b:?$", r"all trademarks",
    # running heads and page footers
    r"[-–—]+\s*\d+\s*[-–—]+$", r"(?:page|seite|página|p\.)\s*\d+(?:\s*(?:of|von|de|/)\s*\d+)?$", r".{1,70}\s[-–—|]\s*page \d+(?: of \d+)?$", r".{1,40}\brev\. ?[\d.]+\s+page \d+$", r".{1,50}\|\s*" + _MONTH + r"\.? \d{1,2}, \d{4}\s*\|\s*p(?:age|\.) ?\d+$", r"back to (?:top|the top|start)", r"(?:site )?version \d[\d.]*\s*\(", r"page printed on\b", r"printed (?:on|from)\b.{0,60}https?:", r"page (?:last )?(?:updated|generated|printed)\b",
]
NOTICE = re.compile("|".join(f"(?:{p})" for p in _PATTERNS))

# Headings of link blocks.
BLOCK_HEAD = re.compile(
    r"(?:related (?:topics|links|articles|pages|content|documents|forms)|more (?:on|from|about|in)\b|see also\b|recent (?:posts|articles|news|updates)\b|latest (?:from|news|posts|updates)\b|"
    r"most (?:read|popular|viewed|shared)\b|popular (?:downloads|posts|articles|topics|pages)\b|on this page$|in this section$|table of contents$|you (?:may|might) also (?:like|be interested)\b|"
    r"(?:.{1,40} )?quick links$|(?:useful|external|related) links\b|trending\b|further reading$|recommended (?:for you|reading)\b|read (?:more|next)$|tags:|categories:|archives?$)"
)
LINK_ITEM = re.compile(
    r"(?:[-*•]\s*)?(?:\[[^\]]*\]\(\w+:[^)]*\)$|https?://\S+$|download .{1,60}\((?:pdf|docx?|xlsx?|zip)\b.*\)$|webinar\b.{1,80}:|news from\b|form \S+ for .{1,60}\([a-z]+\)$|§ ?[\d.]+ [^.;]{2,60}$|[^.;]{2,60}: questions from \S+$|[^.,;]{2,40} in \S+$|[^.,;]{2,30} and [^.,;]{2,30}$)"
)


def folded(line: str) -> str:
    if line.isascii():
        return " ".join(line.split()).lower()
    return _GAP.sub(" ", line).strip().lower()


def is_notice(line: str) -> bool:
    """Whether the folded line is furniture by itself, wherever it stands."""
    return bool(NOTICE.match(line.lstrip("#-*• ") if line[:1] in "#-*•" and not line.startswith(("--", "* ")) else line))


def is_block_item(line: str) -> bool:
    """Whether the folded line can be an entry of a link block: short and no sentence."""
    if len(line) > 120 or SENTENCE_END.search(line):
        return False
    return bool(LINK_ITEM.match(line)) or len(line) <= 40 and line.count(" ") <= 4 and not set(";,\t|") & set(line)


def furniture(lines: list[str], title: str | None = None, page: bool = True, texts: list[str] | None = None) -> set[int]:
    """Numbers of the lines that look like page furniture: notices anywhere, link blocks with their heading, and, if
    `page`, whatever stands before the title. Blank lines end a link block and are never furniture. texts: the lines folded, if at hand."""
    found: set[int] = set()
    texts = [folded(line) for line in lines] if texts is None else texts
    if page:
        wanted = folded(title) if title else None
        first = next((i for i, t in enumerate(texts) if t.startswith("#") or wanted and t.lstrip("# ") == wanted), None)
        if first is not None:
            found.update(i for i in range(first) if texts[i] and not (SENTENCE_END.search(texts[i]) and len(texts[i]) > 60))
    block = False
    for i, t in enumerate(texts):
        if not t:
            block = False
            continue
        bare = t.lstrip("# ")
        if len(bare) <= 80 and BLOCK_HEAD.match(bare) and not SENTENCE_END.search(bare):
            # A heading of a link block only if an entry follows.
            following = next((x for x in texts[i + 1 : i + 4] if x), "")
            if following and is_block_item(following) and not following.startswith("#"):
                block = True
                found.add(i)
                continue
        if t.startswith("#"):
            block = False
            continue
        if NOTICE.match(t):
            found.add(i)
        elif block:
            if is_block_item(t):
                found.add(i)
            else:
                block = False
    return found
