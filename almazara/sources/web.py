"""Acquisition: requests with retries, resumable downloads, paged services, links. SRC-28 to SRC-35.

Downloads run on the driver, or on executors where a table of tasks is given;
the network is the limit, so a bounded number of tasks runs at a time.
"""

from __future__ import annotations

import hashlib
import json
import os
import random
import re
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LONGEST_WAIT_S = 30.0


class RateLimit:
    """At most so many requests a second, evenly spaced."""

    def __init__(self, per_second: float) -> None:
        self.step, self.next = 1.0 / per_second, 0.0

    def wait(self) -> None:
        now = time.monotonic()
        self.next = max(self.next, now)
        time.sleep(self.next - now)
        self.next += self.step


def redacted(url: str, secrets: tuple[str, ...] = ("securityToken", "token", "apikey")) -> str:
    """URL with the values of secret parameters hidden."""
    parts = urllib.parse.urlsplit(url)
    pairs = [(k, "***" if k.lower() in {s.lower() for s in secrets} else v) for k, v in urllib.parse.parse_qsl(parts.query, keep_blank_values=True)]
    return urllib.parse.urlunsplit(parts._replace(query=urllib.parse.urlencode(pairs, safe="*")))


def fetch(url: str, *, params: dict | None = None, data: bytes | None = None, headers: dict | None = None, attempts: int = 5, timeout: float = 60.0, limit: RateLimit | None = None, missing_ok: bool = False, wait: float = 1.0) -> bytes | None:
    """Body of a response. Server errors and rate limits are tried again after growing waits; 404 gives None where allowed."""
    if params:
        url += ("&" if "?" in url else "?") + urllib.parse.urlencode(params)
    for attempt in range(attempts):
        if limit:
            limit.wait()
        try:
            with urllib.request.urlopen(urllib.request.Request(url, data=data, headers=headers or {}), timeout=timeout) as response:
                return response.read()
        except urllib.error.HTTPError as e:
            if e.code == 404 and missing_ok:
                return None
            if e.code < 500 and e.code != 429 or attempt + 1 == attempts:
                raise OSError(f"HTTP {e.code} for {redacted(url)}") from None
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            if attempt + 1 == attempts:
                raise OSError(f"no answer from {redacted(url)}: {e}") from None
        time.sleep(min(LONGEST_WAIT_S, wait * (2**attempt + random.random())))
    return None


def download(url: str, path: str, *, size: int | None = None, md5: str | None = None, attempts: int = 5, wait: float = 1.0) -> str:
    """File of a URL, gone on with from ``path.part`` by a byte range; ``complete`` if it was there already, else ``downloaded``.

    A server that ignores the range starts the file anew; a wrong size or
    checksum removes the part and is an error after the last attempt.
    """

    def sound(p: str) -> bool:
        if size is not None and os.path.getsize(p) != size:
            return False
        if md5 is None:
            return True
        digest = hashlib.md5()
        with open(p, "rb") as f:
            for block in iter(lambda: f.read(1 << 20), b""):
                digest.update(block)
        return digest.hexdigest() == md5.lower()

    if os.path.exists(path) and sound(path):
        return "complete"
    part = path + ".part"
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    for attempt in range(attempts):
        try:
            have = os.path.getsize(part) if os.path.exists(part) else 0
            request = urllib.request.Request(url, headers={"Range": f"bytes={have}-"} if have else {})
            with urllib.request.urlopen(request, timeout=60) as response, open(part, "ab" if response.status == 206 else "wb") as f:
                for block in iter(lambda: response.read(1 << 20), b""):
                    f.write(block)
            if sound(part):
                os.replace(part, path)
                return "downloaded"
            os.remove(part)
        except (urllib.error.URLError, OSError):
            if attempt + 1 == attempts:
                raise
        time.sleep(min(LONGEST_WAIT_S, wait * (2**attempt + random.random())))
    raise OSError(f"{redacted(url)} has not the expected size or checksum")


def multipart(fields: dict[str, str]) -> tuple[bytes, str]:
    """(body, content type) of a form post. SRC-30."""
    mark = uuid.uuid4().hex
    parts = [f'--{mark}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n' for k, v in fields.items()]
    return ("".join(parts) + f"--{mark}--\r\n").encode(), f"multipart/form-data; boundary={mark}"


class _Page(InputPartition):
    pass


class _PagesReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.o = {"page": "pagina", "total": "totalFilas", "size": "tamanioPagina", "rows": "resultados", **options}

    def _get(self, number: int) -> dict:
        return json.loads(fetch(self.o["url"], params={self.o["page"]: number}))

    def partitions(self):
        first = self._get(1)
        pages = -(-int(first.get(self.o["total"], 0)) // max(1, int(first.get(self.o["size"], 1))))
        return [_Page(n) for n in range(1, max(1, pages) + 1)]

    def read(self, partition):
        for place, row in enumerate(self._get(partition.value).get(self.o["rows"]) or []):
            yield partition.value, place, json.dumps(row, ensure_ascii=False, separators=(",", ":"))


class PagedSource(DataSource):
    """``spark.read.format('almazara_pages')``: rows of a paged JSON service, one task a page. SRC-28.

    Options (names of the service's fields have defaults): url, page, total, size, rows.
    """

    @classmethod
    def name(cls) -> str:
        return "almazara_pages"

    def schema(self) -> str:
        return "page int, place int, value string"

    def reader(self, schema) -> DataSourceReader:
        return _PagesReader({k.lower(): v for k, v in self.options.items()})


def read_pages(spark: SparkSession, url: str, **names: str) -> DataFrame:
    """(page, place, value): JSON rows of every page of a service."""
    spark.dataSource.register(PagedSource)
    return spark.read.format("almazara_pages").options(url=url, **names).load()


def download_all(tasks: DataFrame, folder: str, *, workers: int = 4) -> DataFrame:
    """(name, status, error) of a table of tasks name, url, bytes, md5; ``folder`` is one that all executors share. SRC-29, SRC-34."""

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for t in frame.itertuples(index=False):
                try:
                    size = None if t.bytes != t.bytes or t.bytes is None else int(t.bytes)
                    rows.append((t.name, download(t.url, f"{folder}/{t.name}", size=size, md5=t.md5), None))
                except OSError as e:
                    rows.append((t.name, "failed", str(e)))
            yield pd.DataFrame(rows, columns=["name", "status", "error"])

    return tasks.select("name", "url", F.col("bytes").cast("double").alias("bytes"), "md5").repartition(workers).mapInPandas(run, "name string, status string, error string")


def page_links(html: Column, pattern: str, base: str = "") -> Column:
    """Distinct links of a page that match a pattern, sorted, made absolute. SRC-31, SO-03."""
    found = F.regexp_extract_all(html, F.lit(r"""href\s*=\s*["']([^"']+)["']"""), F.lit(1))
    whole = F.transform(F.filter(found, lambda u: u.rlike(pattern)), lambda u: F.when(u.rlike("^https?://"), u).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.ltrim(u, F.lit("/")))))
    return F.array_sort(F.array_distinct(whole))


ATOM = "entry array<struct<title:string,id:string,link:array<struct<_href:string,_rel:string>>>>"


def catalogue_entries(feeds: DataFrame) -> DataFrame:
    """(title, href, code, name): entries of Atom catalogues (column text) with the place code and name of their titles. SRC-32, FN-19."""
    e = feeds.select(F.explode(F.from_xml("text", ATOM, {"ignoreNamespace": "true"})["entry"]).alias("e"))
    href = F.get(F.filter("e.link", lambda x: F.coalesce(x["_href"], F.lit("")) != ""), F.lit(0))["_href"]
    code = F.regexp_extract("e.title", r"^\s*(\d{5}|\d{2})[-\s]", 1)
    name = F.trim(F.regexp_replace(F.regexp_replace("e.title", r"^\s*\d+[-\s]+", ""), r"(?i)\s*(buildings|cadastral ?parcels|addresses)\s*$", ""))
    return e.select(F.col("e.title").alias("title"), href.alias("href"), F.nullif(code, F.lit("")).alias("code"), name.alias("name"))


def market_answer(text: str) -> tuple[str, str | None]:
    """(status, reason) of a market document: ``ok``, ``no_data`` or ``error``. SRC-33."""
    if "Acknowledgement_MarketDocument" not in text[:2000]:
        return "ok", None
    reason = re.search(r"<text>(.*?)</text>", text, re.S)
    said = reason.group(1).strip() if reason else ""
    return ("no_data" if re.search(r"no matching data|not found", said, re.I) else "error"), said or None
