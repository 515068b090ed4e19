"""Problem 2: quantities recorded in different units.

Unit texts are segmented by dynamic programming over tries of numbers' signs,
prefixes, roots, denominators and exponents; ambiguous decompositions are
scored with priors on the dimension of the field. Parsing runs as an Arrow UDF
over the rows' own text columns with a memo of distinct texts in each Python
worker: no shuffle, nothing broadcast, the same plan at any size or skew.
"""

from __future__ import annotations

import math
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings of the parts of unit texts, after lower-casing and folding of micro signs and superscripts.
PREFIXES = {"n": 1e-9, "nano": 1e-9, "u": 1e-6, "micro": 1e-6, "m": 1e-3, "milli": 1e-3, "mili": 1e-3, "c": 1e-2, "centi": 1e-2, "k": 1e3, "kilo": 1e3}
ROOTS = {"sv": "dose", "siev": "dose", "sievert": "dose", "sieverts": "dose", "r": "exposure", "roentgen": "exposure", "roentgens": "exposure", "röntgen": "exposure", "c": "count", "count": "count", "counts": "count", "cuenta": "count", "cuentas": "count", "ct": "count", "cts": "count", "pulsos": "count", "pulses": "count"}
TIMES = {"h": 3600, "hr": 3600, "hrs": 3600, "hour": 3600, "hours": 3600, "hora": 3600, "horas": 3600, "m": 60, "min": 60, "mn": 60, "minute": 60, "minutes": 60, "minuto": 60, "minutos": 60, "s": 1, "sec": 1, "seg": 1, "second": 1, "seconds": 1, "segundo": 1, "segundos": 1}
PER = ["/", "per", "por", "p", " p ", "a la "]
INVERSE = ["-1", "^-1", "**-1", "^(-1)"]
GAPS = [" ", "·", "*", "."]

#: Log-priors of the dimensions of a radiation field, and of ways to write them.
DIMENSION_PRIOR = {("dose", 3600): 0.0, ("exposure", 3600): 0.0, ("count", 60): 0.0, ("count", 1): -0.2, ("count", 3600): -6.0, ("dose", 60): -6.0, ("dose", 1): -6.0, ("exposure", 60): -6.0, ("exposure", 1): -6.0}
IMPLIED_TIME = -2.5
JOINED = -0.5
PREFIX_COST = {"n": -0.1, "u": -0.1, "m": -0.2, "k": -2.0, "c": -4.0}

#: Size of one unit of each code in base units (sieverts or roentgens an hour, counts a minute).
CODES = {"cpm": ("count", 60, 1.0), "cps": ("count", 1, 1.0), "usvh": ("dose", 3600, 1e-6), "nsvh": ("dose", 3600, 1e-9), "msvh": ("dose", 3600, 1e-3), "urh": ("exposure", 3600, 1e-6), "mrh": ("exposure", 3600, 1e-3)}

_SUPERSCRIPT = str.maketrans("⁻⁺⁰¹²³⁴⁵⁶⁷⁸⁹", "-+0123456789")
_NUMBER = re.compile(r"(?:10\^[+-]?\d+|\d+(?:[.,]\d+)?(?:e[+-]?\d+)?)")


def fold(text: str) -> str:
    """Lower case, one kind of micro sign, superscripts and spaces; accents stay."""
    t = unicodedata.normalize("NFC", text).translate(_SUPERSCRIPT).replace("µ", "u").replace("μ", "u").replace("−", "-").replace("⋅", "·").replace("×", "*")
    return re.sub(r"\s+", " ", t).strip().lower()


class Trie:
    """Words by first letters; ``at`` gives every word that starts at a place."""

    def __init__(self, words) -> None:
        self.root: dict = {}
        for word in words:
            node = self.root
            for ch in word:
                node = node.setdefault(ch, {})
            node[""] = word

    def at(self, text: str, start: int):
        node = self.root
        for i in range(start, len(text)):
            if "" in node:
                yield i, node[""]
            node = node.get(text[i])
            if node is None:
                return
        if "" in node:
            yield len(text), node[""]


_TRIES = {"prefix": Trie(PREFIXES), "root": Trie(ROOTS), "time": Trie(TIMES), "per": Trie(PER), "inverse": Trie(INVERSE), "gap": Trie(GAPS)}

#: Characters of the longest run that the grammar can make without a number: one word of each part, and three gaps between any two.
LONGEST_RUN = sum(max(map(len, part)) for part in (PREFIXES, ROOTS, PER, TIMES, INVERSE)) + 4 * 3
_GAPS = re.compile(r"[ ·*.]{4,}")

#: Which part may follow which; a text must end after a part of ENDS.
NEXT = {"start": ("number", "prefix", "root"), "number": ("gap", "prefix", "root"), "prefix": ("root", "gap0"), "root": ("per", "gap", "time", "inverse0"), "gap": ("prefix", "root", "time", "per", "gap"), "per": ("time", "gap2"), "gap2": ("time",), "time": ("inverse", "gap3"), "inverse": (), "gap3": ()}
ENDS = ("root", "time", "inverse", "gap3")


def segment(text: str) -> list[tuple[float, str, int, float]]:
    """Every reading of a folded unit text: (score, dimension, seconds, size), best first.

    Dynamic programming over (place, last part): a state keeps its best score for
    each (root, time, size), so shared suffixes are segmented once.
    """

    @lru_cache(maxsize=None)
    def tails(i: int, last: str, root: str, seconds: int, inverse: bool, sep: bool) -> tuple:
        found: dict = {}

        def keep(score, dim, sec, size):
            if found.get((dim, sec, size), -math.inf) < score:
                found[dim, sec, size] = score

        if i == len(text):
            if root and last in ENDS:
                # A time after a mere gap needs its exponent (uSv h-1); joined letters (usvh, cpm) do not.
                if seconds:
                    keep(0.0, root, seconds, 1.0)
                elif root != "count":
                    keep(IMPLIED_TIME, root, 3600, 1.0)
            return tuple(found.items())
        options = NEXT[last]
        if "number" in options and (m := _NUMBER.match(text, i)):
            raw = m.group().replace(",", ".")
            factor = float(f"1e{raw[3:]}" if raw.startswith("10^") else raw)
            if 0 < factor < math.inf:
                for (d, s, z), sc in tails(m.end(), "number", root, seconds, inverse, False):
                    keep(sc, d, s, z * factor)
        if "prefix" in options and not root:
            for j, w in _TRIES["prefix"].at(text, i):
                for (d, s, z), sc in tails(j, "prefix", root, seconds, inverse, False):
                    keep(sc + PREFIX_COST.get(w[0] if len(w) == 1 else {"micro": "u", "milli": "m", "mili": "m", "nano": "n", "kilo": "k", "centi": "c"}[w], 0.0), d, s, z * PREFIXES[w])
        if "root" in options and not root:
            for j, w in _TRIES["root"].at(text, i):
                for (d, s, z), sc in tails(j, "root", ROOTS[w], seconds, inverse, False):
                    keep(sc, d, s, z)
        if "per" in options and root and not seconds:
            for j, w in _TRIES["per"].at(text, i):
                for (d, s, z), sc in tails(j, "per", root, seconds, inverse, True):
                    keep(sc, d, s, z)
        if "time" in options and root and not seconds:
            for j, w in _TRIES["time"].at(text, i):
                for (d, s, z), sc in tails(j, "time", root, TIMES[w], inverse, sep):
                    keep(sc + (0.0 if sep else JOINED), d, s, z)
        if "inverse" in options and seconds:
            for j, _ in _TRIES["inverse"].at(text, i):
                for (d, s, z), sc in tails(j, "inverse", root, seconds, True, sep):
                    keep(sc, d, s, z)
        if last in ("number", "root", "gap", "per", "time"):
            for j, _ in _TRIES["gap"].at(text, i):
                after = {"per": "gap2", "time": "gap3"}.get(last, "gap" if root else "number")
                for (d, s, z), sc in tails(j, after, root, seconds, inverse, sep):
                    keep(sc - 0.05, d, s, z)
        return tuple(found.items())

    read = [(score + DIMENSION_PRIOR.get((d, s), -9.0), d, s, z) for (d, s, z), score in tails(0, "start", "", 0, False, False)]
    return sorted(read, key=lambda x: -x[0])


def code_of(text: str | None) -> tuple[str, float] | None:
    """(unit code, remaining factor) of a unit text, a written scale included; None where it tells no unit.

    A scale that makes one unit into another (1000 nSv/h) is that unit; a scale
    that makes none (10 cpm) stays as the remaining factor.
    """
    if not text:
        return None
    t = fold(text)
    if not t:
        return None
    t = _GAPS.sub(lambda m: m.group()[:3], t)
    dotted = re.sub(r"(?<=[a-z])\.(?=[a-z]|$)", "", t)  # c.p.m.
    for form in dict.fromkeys((t, dotted)):
        for _, dim, seconds, size in segment(form):
            same = [(code, size / unit) for code, (d, s, unit) in CODES.items() if d == dim and s == seconds]
            if same:
                exact = [c for c in same if math.isclose(c[1], 1.0, rel_tol=1e-9)]
                return (exact[0][0], 1.0) if exact else min(same, key=lambda c: abs(math.log(c[1])))
    return None


#: A run of words, signs and letters in which a unit may stand.
_WORDS = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[/^·*⁻¹.-]")


def code_in(text: str | None) -> tuple[str, float] | None:
    """The unit that a free text tells, or None.

    The longest run of words that reads wholly as a rate is taken. A mention
    behind a number (``a source of 300 cpm``) is a quantity and tells no unit of
    the value. Runs of one or two letters count only with a denominator.
    """
    if not text:
        return None
    t = fold(text)
    words = list(_WORDS.finditer(t))
    best = None
    for a in range(len(words)):
        if not words[a].group()[0].isalpha():
            continue
        # White space is single after folding: two characters back tell what stands before.
        before = t[max(0, words[a].start() - 2) : words[a].start()].rstrip()
        if before and (before[-1].isdigit() or before[-1] in "/^"):
            continue
        # No reading is longer than the grammar allows.
        last = a + 1
        while last < len(words) and words[last].end() - words[a].start() <= LONGEST_RUN:
            last += 1
        for b in range(last, a, -1):
            run = t[words[a].start() : words[b - 1].end()]
            if best and len(run) <= best[0]:
                break
            if not re.search(r"/|\bper\b|\bpor\b|cpm|cps|sv|h", run) or len(run) < 3:
                continue
            readings = segment(run)
            if readings and readings[0][0] > IMPLIED_TIME and (found := code_of(run)):
                best = (len(run), found)
                break
    return best[1] if best else None


RESULT = T.StructType([T.StructField("unit_code", T.StringType()), T.StructField("scale", T.DoubleType()), T.StructField("told_by", T.StringType())])

_MEMO: dict = {}


def _memo(kind: str, text, limit: int = 200_000):
    key = kind, text
    if key not in _MEMO:
        if len(_MEMO) >= limit:
            _MEMO.clear()
        _MEMO[key] = (code_of if kind == "unit" else code_in)(text if isinstance(text, str) else None)
    return _MEMO[key]


def told_unit(unit: Column, texts: list[Column], names: list[str]) -> Column:
    """struct(unit_code, scale, told_by): the unit that the unit column or else the first telling text says."""

    @F.pandas_udf(RESULT)
    def tell(columns: pd.DataFrame) -> pd.DataFrame:
        code, scale, by = [], [], []
        for row in zip(*(columns[c] for c in columns.columns)):
            found = who = None
            for k, text in enumerate(row):
                if text is not None and (found := _memo("unit" if k == 0 else "text", text)):
                    who = names[k]
                    break
            code.append(found[0] if found else None)
            scale.append(found[1] if found else None)
            by.append(who)
        return pd.DataFrame({"unit_code": code, "scale": scale, "told_by": by})

    return tell(F.struct(unit.alias("c0"), *[t.alias(f"c{i + 1}") for i, t in enumerate(texts)]))


def with_source_unit(df: DataFrame, *, unit: str, texts: list[str], exact_codes: list[str] | None = None) -> DataFrame:
    """``df`` with ``source_unit``, ``unit_scale`` and ``unit_told_by``.

    ``unit`` is used before ``texts``, in their order; an exact code is taken by
    a JVM expression, everything else by the segmentation. Null, blank, unknown
    unit texts tell nothing; the three columns are then null.
    """
    exact = F.col(unit).isin(*(exact_codes or list(CODES)))
    plain = F.when(exact, F.struct(F.col(unit).alias("unit_code"), F.lit(1.0).alias("scale"), F.lit(unit).alias("told_by")))
    # Exact codes are sent as null, so that they cost the Python workers nothing.
    send = lambda c: F.when(~F.coalesce(exact, F.lit(False)), F.col(c))
    told = F.coalesce(plain, told_unit(send(unit), [send(t) for t in texts], [unit, *texts]))
    return df.withColumn("_told", told).withColumn("source_unit", F.col("_told.unit_code")).withColumn("unit_scale", F.col("_told.scale")).withColumn("unit_told_by", F.when(F.col("_told.unit_code").isNotNull(), F.col("_told.told_by"))).drop("_told")


def convert(df: DataFrame, *, value: str, factors: DataFrame, devices: DataFrame, device: str) -> DataFrame:
    """``df`` (with ``source_unit``) with ``value_usvh``: the value in µSv/h, null where it cannot be told.

    ``factors``: unit_code, to_usvh (a few rows). Counts use the device's
    ``cpm_per_usvh``. Join sides are left to Catalyst, which broadcasts a side
    only under its size threshold.
    """
    f = factors.select(F.col("unit_code").alias("_code"), F.when(~F.isnan("to_usvh"), F.col("to_usvh")).alias("_factor"))
    d = devices.select(F.col("device_id").alias("_device"), F.col("cpm_per_usvh").alias("_cpm"))
    out = df.join(f, F.col("source_unit") == F.col("_code"), "left").join(d, F.col(device) == F.col("_device"), "left")
    per_minute = F.when(F.col("source_unit") == "cps", 60.0).when(F.col("source_unit") == "cpm", 1.0)
    base = F.coalesce(F.col("_factor"), F.when(F.col("_cpm") > 0, per_minute / F.col("_cpm")))
    return out.withColumn("value_usvh", F.col(value) * F.coalesce("unit_scale", F.lit(1.0)) * base).drop("_code", "_factor", "_device", "_cpm")
