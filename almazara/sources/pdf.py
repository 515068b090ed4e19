"""Text of PDF pages. SRC-20, PLN-08.

``pypdf`` reads them where it is installed. Else a small reader of our own
handles plain and deflated content streams of literal and hexadecimal strings in
the standard encodings, which is enough for simply made files; a page that it
cannot read has no text.
"""

from __future__ import annotations

import io
import re
import zlib

import pandas as pd
from pyspark.sql import DataFrame

try:
    import pypdf
except ImportError:
    pypdf = None

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)endobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.S)
_SHOWN = re.compile(rb"\[((?:[^\[\]\\]|\\.)*)\]\s*TJ|(\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>)\s*(?:Tj|'|\")|(T\*|-?[\d.]+\s+-?[\d.]+\s+T[dD])", re.S)
_STRING = re.compile(rb"\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _text(token: bytes) -> str:
    if token.startswith(b"<"):
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = re.sub(rb"\\(\d{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)
    return raw[2:].decode("utf-16-be", "replace") if raw.startswith(b"\xfe\xff") else raw.decode("cp1252", "replace")


def simple_pages(data: bytes) -> list[str]:
    """Texts of the pages of a simply made file, in the order of its objects."""
    objects = {int(m[1]): m[2] for m in _OBJECT.finditer(data)}
    pages = []
    for body in objects.values():
        if not re.search(rb"/Type\s*/Page\b(?!s)", body):
            continue
        out = []
        refs = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)
        for ref in re.findall(rb"(\d+)\s+\d+\s+R", refs[1]) if refs else []:
            held = objects.get(int(ref), b"")
            stream = _STREAM.search(held)
            if not stream:
                continue
            content = stream[1]
            if b"/FlateDecode" in held:
                try:
                    content = zlib.decompress(content)
                except zlib.error:
                    continue
            for m in _SHOWN.finditer(content):
                out.append("\n" if m[3] else "".join(_text(t) for t in _STRING.findall(m[1])) if m[1] is not None else _text(m[2]))
        pages.append("".join(out).strip())
    return pages


def page_texts(data: bytes, wanted: list[int]) -> list[tuple[int, str]]:
    """(page, text) of the wanted pages that the file has, counted from 1."""
    if pypdf is not None:
        reader = pypdf.PdfReader(io.BytesIO(data))
        return [(n, reader.pages[n - 1].extract_text() or "") for n in wanted if 1 <= n <= len(reader.pages)]
    pages = simple_pages(data)
    return [(n, pages[n - 1]) for n in wanted if 1 <= n <= len(pages)]


def read_pages(files: DataFrame, needed: DataFrame) -> DataFrame:
    """(pdf_name, page, text) of the needed pages. ``files``: path, content (``binaryFile``); ``needed``: pdf_name, page."""
    from pyspark.sql import functions as F

    lists = needed.groupBy("pdf_name").agg(F.sort_array(F.collect_set("page")).alias("pages"))
    rows = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("pdf_name"), "content").join(lists, "pdf_name")

    def run(frames):
        for frame in frames:
            for name, content, pages in zip(frame["pdf_name"], frame["content"], frame["pages"]):
                got = page_texts(bytes(content), [int(p) for p in pages])
                yield pd.DataFrame({"pdf_name": [name] * len(got), "page": [n for n, _ in got], "text": [t for _, t in got]})

    return rows.mapInPandas(run, "pdf_name string, page int, text string")
