"""Problem 10: keyword-stuffed and link-list pages.

Every line is cut into units, and every unit reduced to a shape: its kind, the
size of its word count, how it is capitalised, its chief separator and its links.
The units of a page are grouped by shape, and a page is flagged where a few
non-sentence shapes - repeated keywords, listed links, product tags - hold more
than half of its characters. Sentences, and records such as lists of names or
tables of figures, are left alone; a page of ever new shapes repeats nothing. One
narrow pass over whole texts: no shuffle, no state beside the page, so pages of
any skew cost the same.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame

#: Share of a page's characters beyond which it is flagged.
FLAGGED_SHARE = 0.5
#: Shapes that must hold that share: the largest of the page.
FEW_SHAPES = 4
#: Words beside each link up to which a unit is a link list and no prose.
WORDS_PER_LINK = 12
#: Least count and share of a page's content words at which a word repeated inside a sentence is a stuffed keyword.
STUFFED_COUNT, STUFFED_SHARE = 4, 0.05
#: Share of a fragment's words that must recur on the page for it to count as keywords.
RECURRING_SHARE = 0.4

_LINK = re.compile(r"(?:https?://|www\.)[^\s)\]>\"']+|(?<![\w.@-])[a-z0-9][a-z0-9-]*(?:\.[a-z0-9-]+)*\.[a-z]{2,12}(?:/[^\s)\]>\"']*)?(?![\w.@])", re.I)
_MARKUP = re.compile(r"</?a\b[^<>]*>|\[([^\[\]]*)\]\([^()]*\)", re.I)
_UNIT = re.compile(r"(?<=[.!?…])\s+(?=[^\s])")
_ENDED = re.compile(r"[.!?…:]['\"»”)\]]*$")
_STARTED = re.compile(r"^['\"«“¿¡(\[]*(?:[A-ZÀ-ÖØ-Þ]|\d)")
_BULLET = re.compile(r"^\s*(?:[-*»>•·+–—]+|\d+[.)])\s+")
_WORD = re.compile(r"[^\W\d_]+")
_HASHTAG = re.compile(r"#\w")
_PLAIN = re.compile(r"[​-‍﻿]")
_SPACED = re.compile(r"(?<=\w)[.*](?=\w)")
#: A sentence without any sign of lists, links or tags: told without further work.
_PLAIN_SENTENCE = re.compile(r"[A-ZÀ-ÖØ-Þ¿¡«\"][^#|<>\[\]/·•*+@_{}=]*[.!?…]")
_DOTTED = re.compile(r"[a-z]\.[a-z]")
_SEPARATOR = re.compile(r"\s[-–—]\s|[,;|/·•#]")


def _simple(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


def units_of(text: str) -> list[str]:
    """Lines, cut after the ends of sentences; a question or exclamation goes on where a small letter follows."""
    out = []
    for line in text.split("\n"):
        line = line.strip()
        if not line:
            continue
        joined = ""
        for piece in _UNIT.split(line):
            if joined and joined[-1] in "!?" and piece[:1].islower():
                joined += " " + piece
            else:
                if joined:
                    out.append(joined)
                joined = piece
        out.append(joined)
    return out


def shape_of(unit: str) -> tuple[str, tuple]:
    """(kind, shape) of a unit; kinds: sentence, record, links, hashtags, tag, fragment."""
    links = _LINK.findall(unit) if "." in unit or "://" in unit else []
    bare = _MARKUP.sub(r" \1 ", unit) if links and ("<" in unit or "](" in unit) else unit
    if links:
        bare = _LINK.sub(" ", bare)
    body = _BULLET.sub("", bare, count=1)
    words = _WORD.findall(body)
    small = sum(w[0].islower() for w in words)
    separators = Counter(m.strip() or "-" for m in _SEPARATOR.findall(body))
    tags = len(_HASHTAG.findall(body))
    started, ended = _STARTED.match(body), _ENDED.search(unit)
    if links and len(words) <= WORDS_PER_LINK * len(links) and not (len(links) == 1 and words and started and ended):
        kind = "links"
    elif tags and 2 * tags >= len(body.split()):
        kind = "hashtags"
    elif body.count("|") >= 2 and small and any(c.isdigit() for c in body):
        kind = "tag"
    elif not small:
        kind = "record"
    elif started and ended and not (unit[-1] == ":" and len(words) > 12):
        kind = "sentence"
    else:
        kind = "fragment"
    size = "" if not words else "few" if len(words) <= 6 else "many"
    capitals = "upper" if not small else "lower" if small == len(words) else "mixed"
    return kind, (kind, size, capitals, max(separators, key=lambda m: (separators[m], m), default=""), min(len(links), 2))


def page_shapes(text: str | None) -> tuple[int, int, int, str]:
    """(characters in the ``FEW_SHAPES`` largest spam shapes, characters in all, spam shapes, largest spam shape) of a page."""
    if not text or not text.strip():
        return 0, 0, 0, ""
    text = _PLAIN.sub("", text)
    units = units_of(text)
    sentences, shaped = [], []
    for u in units:
        if _PLAIN_SENTENCE.fullmatch(u) and u != u.upper() and not _DOTTED.search(u):
            sentences.append(u)
        else:
            kind, shape = shape_of(u)
            if kind == "sentence":
                sentences.append(u)
            else:
                shaped.append((u, kind, shape))
    total = sum(map(len, units))
    chars: dict = defaultdict(int)
    if shaped:
        linked = sum(kind == "links" for _, kind, _ in shaped)
        loose = [(u, shape) for u, kind, shape in shaped if kind == "fragment"]
        # Fragments are keywords where their words recur on the page; short lines are menu items where the page lists links.
        words = [[_simple(w) for w in _WORD.findall(_SPACED.sub(lambda m: " " if m.group() == "*" else "", u.lower())) if len(w) >= 4] for u, _ in loose]
        count = Counter(w for ws in words for w in ws)
        menu = linked > 0 and 4 * linked >= sum(kind in ("fragment", "record") and any(c.isalpha() for c in u) for u, kind, _ in shaped)
        for (u, shape), ws in zip(loose, words):
            again = sum(count[w] >= 2 for w in ws)
            if (ws and again >= RECURRING_SHARE * len(ws)) or (menu and len(ws) <= 6):
                chars[shape] += len(u)
        if menu:
            for u, kind, shape in shaped:
                if kind == "record" and "," not in u and 1 <= len(_WORD.findall(u)) <= 6:
                    chars[shape] += len(u)
    if len(sentences) > 1:
        count = Counter(_WORD.findall(text.lower()))
        content = {w: n for w, n in count.items() if len(w) >= 4}
        least = max(STUFFED_COUNT, STUFFED_SHARE * sum(content.values()))
        keywords = {w for w, n in content.items() if n >= least}
        if keywords:
            for u in sentences:
                own = [w for w in _WORD.findall(u.lower()) if w in keywords]
                if len(own) > len(set(own)):
                    chars["stuffed", *shape_of(u)[1][1:]] += len(u)
    for u, kind, shape in shaped:
        if kind in ("links", "hashtags", "tag"):
            chars[shape] += len(u)
    spam = sum(sorted(chars.values())[-FEW_SHAPES:])
    largest = max(chars, key=chars.get, default=None)
    return spam, total, len(chars), "/".join(map(str, largest)) if largest else ""


SCHEMA = "doc_id long, spam_chars long, text_chars long, spam_shapes int, largest_shape string, flagged boolean"


def _score(frames):
    for frame in frames:
        rows = [page_shapes(t) for t in frame["text"]]
        out = pd.DataFrame(rows, columns=["spam_chars", "text_chars", "spam_shapes", "largest_shape"])
        out.insert(0, "doc_id", frame["doc_id"].to_numpy())
        out["spam_shapes"] = out["spam_shapes"].astype("int32")
        out["flagged"] = out["spam_chars"] > FLAGGED_SHARE * out["text_chars"]
        yield out


def page_scores(documents: DataFrame) -> DataFrame:
    """One row per document: its characters in few spam shapes and in all, its spam shapes and whether it is flagged.

    Null and blank texts have no characters and are not flagged; copies are
    judged alike; rows with a null doc_id are left out; other columns are
    ignored. An empty table gives no rows.
    """
    return documents.select("doc_id", "text").where("doc_id is not null").mapInPandas(_score, SCHEMA)
