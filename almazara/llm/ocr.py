"""Problem 5: noise in text from scanned pages.

1. Furniture: lines reduced to shapes (figures to a sign, look-alike glyphs to one
   class); shapes that stand at page places on a large share of all texts, or of
   the texts of one publication, are headers, footers and page numbers.
2. Words broken over lines or pages are joined; whether the hyphen belongs to the
   word is told by the corpus counts of both spellings.
3. Misread words: words that look alike share a glyph skeleton, so the rare word
   meets its frequent neighbours by an equi-join. The context of each occurrence,
   in skip-gram vectors trained on the same corpus, decides whether and which.
4. The text is reflowed into paragraphs with the repairs applied.

Counts cover all texts, and every occurrence carries its context from the page, so
that pages are not met again. The vectors are trained on all texts. What is sent to
every executor: common furniture shapes and trusted words, which each hold at least a
fixed share of all texts or words, so there can be only so many, and the vectors of
all words that stand ``TRUSTED_COUNT`` times, which grow with the vocabulary.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almazara.runtime import materialize

# Glyphs that scans confuse, each with the sign of its class; pairs of glyphs seen as one.
GLYPH_CLASS = {"@": "a", "4": "a", "0": "o", "6": "o", "8": "o", "b": "o", "c": "e", "f": "r", "1": "i", "!": "i", "|": "i", "l": "i", "t": "i", "7": "i", "5": "s", "$": "s", "9": "g", "q": "g", "2": "z"}
GLYPH_PAIRS = {"m": "rn", "d": "cl", "u": "ii", "h": "li", "w": "vv", "ﬁ": "fi", "ﬂ": "fl", "ß": "ss"}
DECODED = {"@": "a", "0": "o", "1": "l", "5": "s", "!": "i", "|": "l", "$": "s", "ﬁ": "fi", "ﬂ": "fl", "4": "a", "8": "b"}
HYPHENS = "-­¬‐‑"

#: Share of texts on which a line's shape must stand to be furniture, and the least number of texts: of all, and of one publication.
FURNITURE_SHARE, FURNITURE_TEXTS, PUBLICATION_TEXTS = 0.015, 3, 8
#: Columns that tell publications apart, where a table has them.
PUBLICATION = ("legislature", "organo")
#: Share of all words from which a word is trusted (at most 1 / share words are), and the least count.
TRUSTED_SHARE, TRUSTED_COUNT = 1e-5, 5
#: Least count of a look-alike that corrects, and how many times as frequent as a clean word it must be.
CANDIDATE_COUNT, RATIO = 3, 2.0
#: Least support of a correction of a clean word: cosine of the context to the look-alike's vector, and a tenth of the logarithm of how many times as frequent it is.
LEAST_SUPPORT = 0.25
#: How many times as frequent a look-alike must be where the context tells nothing.
RATIO_ALONE = 1000.0
#: Words for which the training of the vectors takes a further part, up to one part for each core.
VECTOR_WORDS = 1_000_000
VECTOR_SIZE, WINDOW = 32, 4

_CLEAN = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_EDGES = " \t\r\f\v.,;:()[]{}«»\"'“”‘’…—–?¿¡*·•<>/"
_TAIL_HYPHEN = re.compile(rf"[^\W_][{HYPHENS}]$")
_ENDED = re.compile(r"[.!?:…]['\"»”)]*$")
_DIGIT, _FIGURES, _LONG_FIGURE = re.compile(r"\d"), re.compile(r"[\d/.,:-]+"), re.compile(r"\d{2,}")


class _Skeletons(dict):
    """Skeleton of each letter, worked out when it is first met; for ``str.translate``."""

    def __missing__(self, code: int) -> str:
        plain = "".join(c for c in unicodedata.normalize("NFD", chr(code).lower()) if not unicodedata.combining(c) and c != "~")
        out = "".join(GLYPH_CLASS.get(g, g) for c in plain for g in GLYPH_PAIRS.get(c, c))
        self[code] = out
        return out


_SKELETON = _Skeletons()


def skeleton(word: str) -> str:
    """Glyph skeleton: equal for words that plausible glyph edits turn into one another."""
    return word.translate(_SKELETON)


def line_shape(line: str) -> str:
    """Shape of a line: figures to ``#``, other words to skeletons, spaces to one."""
    if not _DIGIT.search(line):
        return " ".join(line.translate(_SKELETON).split())
    words = []
    for w in line.split():
        inner = w.strip(_EDGES + HYPHENS)
        words.append("#" if inner and _FIGURES.fullmatch(inner) else re.sub(r"\d+", "#", w) if _LONG_FIGURE.search(w) else skeleton(w))
    return " ".join(words)


def shape_key(line: str) -> int:
    """64 bits that stand for the shape of a line."""
    return int.from_bytes(hashlib.blake2b(line_shape(line).encode(), digest_size=8).digest(), "big", signed=True)


def core(token: str) -> str:
    """Word of a token in lower case without punctuation around it; empty if there is no letter."""
    t = token.strip(_EDGES).rstrip("!").strip(_EDGES + HYPHENS).lower()
    return t if any(map(str.isalpha, t)) else ""


class _Cores(dict):
    """Words of the tokens met before; emptied when there are very many."""

    def __missing__(self, token: str) -> str:
        if len(self) > 500_000:
            self.clear()
        out = self[token] = core(token)
        return out


def _lines(text: str) -> list[str]:
    return text.replace("\r\n", "\n").replace("\r", "\n").replace("\f", "\n").split("\n")


def _shape_rows(frames):
    for frame in frames:
        count, edges, numbered = Counter(), Counter(), {}
        for group, text in zip(frame["publication"], frame["speech_text"]):
            lines = [line.strip() for line in _lines(text)]
            if len(lines) < 2:
                continue
            seen: dict = {}
            for i, s in enumerate(lines):
                # A line that ends a sentence is text, unless it has no letter.
                if not s or s[-1] in ".!?:;,…" and any(map(str.isalpha, s)):
                    continue
                edge = i == 0 or i + 1 == len(lines) or not lines[i - 1] or not lines[i + 1] or _DIGIT.search(lines[i - 1]) is not None or _DIGIT.search(lines[i + 1]) is not None
                key = group, shape_key(s)
                seen[key] = seen.get(key, False) or edge
                if _DIGIT.search(s) and "#" in line_shape(s):
                    numbered[key] = True
            count.update(seen)
            edges.update(k for k, edge in seen.items() if edge)
        rows = [(g, k, n, edges[g, k], (g, k) in numbered) for (g, k), n in count.items()]
        yield pd.DataFrame(rows, columns=["publication", "shape", "n", "edges", "numbered"]).astype({"shape": "int64", "n": "int64", "edges": "int64", "numbered": "bool"})


def furniture_shapes(texts: DataFrame) -> tuple[list[int], DataFrame]:
    """Shapes of headers, footers and page numbers: the common ones, and (publication, own) those of single publications.

    ``texts``: publication, speech_text. A shape with figures, or one that mostly
    stands at page places, is furniture if the texts on which it stands reach the
    share of all texts or of the texts of a publication. A text has so many lines, so at most lines /
    ``FURNITURE_SHARE`` shapes are common, which bounds what comes to the driver;
    those of publications stay a table.
    """
    sizes = materialize(texts.groupBy("publication").agg(F.count("*").alias("texts")), "publications")
    all_ = int(sizes.agg(F.sum("texts")).first()[0] or 0)
    counted = texts.select("publication", "speech_text").mapInPandas(_shape_rows, "publication string, shape long, n long, edges long, numbered boolean")
    counted = counted.groupBy("publication", "shape").agg(F.sum("n").alias("n"), F.sum("edges").alias("edges"), F.max("numbered").alias("numbered"))
    # A shape has a row for each of its publications.
    everywhere = Window.partitionBy("shape")
    counted = counted.select("*", F.sum("n").over(everywhere).alias("all_n"), F.sum("edges").over(everywhere).alias("all_edges"), F.max("numbered").over(everywhere).alias("all_numbered"))
    placed = lambda numbered, edges, n: F.col(numbered) | (2 * F.col(edges) >= F.col(n))
    is_common = placed("all_numbered", "all_edges", "all_n") & (F.col("all_n") >= F.greatest(F.lit(FURNITURE_TEXTS), F.lit(FURNITURE_SHARE * all_)))
    is_own = placed("numbered", "edges", "n") & (F.col("n") >= F.greatest(F.lit(PUBLICATION_TEXTS), FURNITURE_SHARE * F.col("texts")))
    kept = counted.join(sizes, "publication").select("publication", "shape", is_common.alias("common"), is_own.alias("own")).where(F.col("common") | F.col("own"))
    kept = materialize(kept, "shapes")
    common = [r.shape for r in kept.where("common").select("shape").distinct().collect()]
    return common, materialize(kept.where("own").groupBy("publication").agg(F.collect_list("shape").alias("own")), "furniture")


def read_page(text: str, furniture: set[int]) -> tuple[list[str], list[list[str]]]:
    """(furniture lines, paragraphs as lists of raw tokens).

    ``furniture``: shape keys. A broken word is one token: left, a unit separator,
    right. Blank lines end a paragraph unless a page break stands there in
    mid-sentence.
    """
    found, paragraphs = [], []
    current: list[str] = []
    pending = ""  # a token that the line's end broke
    page = False  # furniture since the last line of text

    def close() -> None:
        nonlocal current
        if current:
            paragraphs.append(current)
            current = []

    blank = False
    lines = _lines(text)
    paged = len(lines) > 1
    for line in lines:
        s = line.strip()
        if not s:
            blank = True
            continue
        if paged and furniture and shape_key(s) in furniture:
            found.append(s)
            page = True
            continue
        tokens = s.split()
        if blank and not pending and not (page and current and not _ENDED.search(current[-1])):
            close()
        if pending:
            if tokens[0][0].isalpha() or tokens[0][0] in "@!|$015":
                tokens[0] = f"{pending}\x1f{tokens[0]}"
            else:
                current.append(pending)
            pending = ""
        if s[-1] in HYPHENS and len(s) > 1 and _TAIL_HYPHEN.search(s[-2:]):
            pending = tokens.pop().rstrip(HYPHENS)
        current += tokens
        blank = page = False
    if pending:
        current.append(pending)
    close()
    return found, paragraphs


def _word_of(token: str, cores: dict) -> str:
    """Word of a raw token; a broken one keeps its separator, unless one part is no word."""
    if "\x1f" not in token:
        return cores[token]
    left, _, right = token.partition("\x1f")
    left, right = cores[left], cores[right]
    return f"{left}\x1f{right}" if left and right else left or right


def _page_rows(common: list[int]):
    def run(frames):
        everywhere, cores = set(common), _Cores()
        for frame in frames:
            rows = []
            for i, text, own in zip(frame["intervention_id"], frame["speech_text"], frame["own"]):
                lines, paragraphs = read_page(text, everywhere if own is None else everywhere.union(own.tolist()))
                words = [w for p in paragraphs for t in p if (w := _word_of(t, cores))]
                rows.append((i, list(dict.fromkeys(lines)), words))
            yield pd.DataFrame(rows, columns=["intervention_id", "furniture", "words"])

    return run


def _skeleton_column(words):
    @F.pandas_udf("string")
    def to_skeleton(word: pd.Series) -> pd.Series:
        return word.map(lambda w: skeleton(w) if isinstance(w, str) else None)

    return to_skeleton(words)


#: Accents that a misread glyph may take away; any other accent must be the same in both words.
_LOST_ACCENTS = {"í": "i", "ó": "o", "ñ": "n"}


def _glyph_class(ch: str) -> str:
    return GLYPH_CLASS.get(ch, ch)


def edit_cost(seen: str, right: str) -> int | None:
    """Least number of plausible glyph edits that make ``seen`` of ``right``; None where there is no way.

    Glyphs of one class, a pair of glyphs and the glyph it looks like, and the
    listed accented letters and their likenesses may stand for one another. An
    accent alone is a spelling and no misreading.
    """
    known: dict = {}

    def cost(i: int, j: int) -> float:
        if i == len(seen) and j == len(right):
            return 0
        if (i, j) in known:
            return known[i, j]
        best = float("inf")
        if i < len(seen) and j < len(right):
            a, b = seen[i], right[j]
            plain = _LOST_ACCENTS.get(b, b)
            if a == b:
                best = cost(i + 1, j + 1)
            elif a != plain and _glyph_class(a) == _glyph_class(plain):
                best = 1 + cost(i + 1, j + 1)
            if b == "ñ" and seen[i : i + 2] == "n~":
                best = min(best, 1 + cost(i + 2, j + 1))
            pair = GLYPH_PAIRS.get(b)
            if pair and len(seen) - i >= 2 and all(_glyph_class(x) == _glyph_class(y) for x, y in zip(seen[i : i + 2], pair)):
                best = min(best, 1 + cost(i + 2, j + 1))
            pair = GLYPH_PAIRS.get(a)
            if pair and right[j : j + 2] == pair:
                best = min(best, 1 + cost(i + 1, j + 2))
        known[i, j] = best
        return best

    least = cost(0, 0)
    return None if least == float("inf") else int(least)


def _decode(word: str) -> str | None:
    """Letters for the odd glyphs of a word without a look-alike; None if it is no word."""
    if sum(c.isalpha() or c == "-" for c in word) < 0.6 * len(word) or len(word) < 4 or re.search(r"\d\d", word):
        return None
    t = word.replace("n~", "ñ")
    t = re.sub(r"6(?=$|n$|[^aeiouáéíóú\W\d][^\W\d])", "ó", t).replace("6", "b")
    t = "".join(DECODED.get(c, c) for c in t)
    return t if _CLEAN.fullmatch(t) else None


def _cost_column(words, fixes):
    """Plausible glyph edits from a word to its look-alike; null where there is no way."""

    @F.pandas_udf("int")
    def cost(word: pd.Series, fix: pd.Series) -> pd.Series:
        return pd.Series([edit_cost(w, f) for w, f in zip(word, fix)], dtype="Int32")

    return cost(words, fixes)


def _decoded_column(words):
    @F.pandas_udf("string")
    def decoded(word: pd.Series) -> pd.Series:
        return word.map(lambda w: _decode(w) if isinstance(w, str) else None)

    return decoded(words)


class Vectors:
    """Skip-gram vectors of trusted words, by word."""

    def __init__(self, words: list[str], matrix: np.ndarray) -> None:
        self.index = {w: i for i, w in enumerate(words)}
        norm = np.linalg.norm(matrix, axis=1, keepdims=True) if len(matrix) else 1.0
        self.matrix = (matrix / np.maximum(norm, 1e-12)).astype(np.float32)

    def cosine(self, context: list[str], word: str) -> float | None:
        """Cosine of the mean of a context to a word; None where either is unknown."""
        rows = [self.index[w] for w in context if w in self.index]
        if not rows or word not in self.index:
            return None
        mean = self.matrix[rows].mean(axis=0)
        return float(mean @ self.matrix[self.index[word]] / max(float(np.linalg.norm(mean)), 1e-9))


def learn_vectors(pages: DataFrame, counts: DataFrame) -> Vectors:
    """Skip-gram vectors learnt from all texts.

    ``counts``: word, n of all words of ``pages``. Words that stand
    ``TRUSTED_COUNT`` times have a vector. The texts are dealt out to one part for
    every ``VECTOR_WORDS`` words, but not more parts than cores; parts are trained side by
    side from the same start and averaged.
    """
    from pyspark.ml.feature import Word2Vec

    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    if (most or 0) < TRUSTED_COUNT:
        return Vectors([], np.zeros((0, VECTOR_SIZE)))
    parts = max(1, min(pages.sparkSession.sparkContext.defaultParallelism, total // VECTOR_WORDS))
    model = Word2Vec(vectorSize=VECTOR_SIZE, windowSize=WINDOW, minCount=TRUSTED_COUNT, maxIter=1, numPartitions=parts, stepSize=0.05, seed=7, inputCol="words", outputCol="v").fit(pages.select("words"))
    rows = model.getVectors().collect()
    return Vectors([r.word for r in rows], np.array([r.vector.toArray() for r in rows]).reshape(len(rows), VECTOR_SIZE))


def corrections(counts: DataFrame) -> DataFrame:
    """(word, clean, n, options, decoded): the look-alikes of every distinct word that has any.

    ``counts``: word, n. A clean word (letters and inner hyphens) has the clean
    look-alikes ``RATIO`` times as frequent; a word with odd glyphs every clean
    look-alike, or else is decoded letter by letter.
    """
    odd_sign = F.col("word").rlike(r"[@!|$~0-9ﬁﬂ]")
    tagged = counts.withColumn("skeleton", _skeleton_column(F.col("word"))).withColumn("clean", F.col("word").rlike(r"^\p{L}+(-\p{L}+)*$") & ~odd_sign).where(F.col("clean") | odd_sign)
    tagged = materialize(tagged, "words")
    candidates = tagged.where(F.col("clean") & (F.col("n") >= CANDIDATE_COUNT)).select("skeleton", F.col("word").alias("fix"), F.col("n").alias("cn"))
    pairs = tagged.join(candidates, "skeleton").where((F.col("word") != F.col("fix")) & (~F.col("clean") | (F.col("cn") >= RATIO * F.col("n"))))
    pairs = pairs.withColumn("cost", _cost_column(F.col("word"), F.col("fix"))).where(F.col("cost").isNotNull())
    looked = pairs.groupBy("word").agg(F.first("clean").alias("clean"), F.first("n").alias("n"), F.collect_list(F.struct("cost", "cn", "fix")).alias("options"))
    alone = tagged.where(~F.col("clean")).join(looked.select("word"), "word", "left_anti").withColumn("decoded", _decoded_column(F.col("word"))).where(F.col("decoded").isNotNull())
    return looked.withColumn("decoded", F.lit(None).cast("string")).unionByName(alone.select("word", "clean", "n", F.lit(None).cast(looked.schema["options"].dataType).alias("options"), "decoded"))


def _suspects(trusted: list[str]):
    """A function for mapInArrow: (intervention_id, words) to one row for each broken or not trusted word, with the words around it."""

    def run(batches):
        known = pa.array(trusted, pa.string())
        for batch in batches:
            words = batch.column("words")
            flat = words.flatten()
            suspect = pc.or_(pc.invert(pc.is_in(flat, value_set=known)), pc.match_substring(flat, "\x1f"))
            at = np.flatnonzero(suspect.to_numpy(zero_copy_only=False))
            starts = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))])
            row = np.searchsorted(starts, at, side="right") - 1
            first, last = np.maximum(starts[row], at - WINDOW), np.minimum(starts[row + 1], at + WINDOW + 1)
            # The words from four before to four after, its own left out.
            size = last - first
            ends = np.cumsum(size)
            near = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(first, size)
            near = near[near != np.repeat(at, size)]
            offsets = np.concatenate([[0], np.cumsum(size - 1)]).astype(np.int32)
            context = pa.ListArray.from_arrays(pa.array(offsets), flat.take(pa.array(near)))
            yield pa.RecordBatch.from_arrays([batch.column("intervention_id").take(pa.array(row)), pa.array((at - starts[row]).astype(np.int32)), flat.take(pa.array(at)), context], names=["intervention_id", "at", "raw", "context"])

    return run


def _choose(vectors: Vectors):
    """Each occurrence to the look-alike that its own context, its count and its edits speak for, or none.

    A clean word is corrected only where context and count together support the
    look-alike; where the context or the look-alike has no vector, only by one very
    much more frequent. Broken words are given whole, corrected or not.
    """

    def chosen(word: str, clean: bool, n: int, options, context: list[str]) -> str | None:
        scored = []
        for o in options:
            cosine = vectors.cosine(context, o["fix"])
            ratio = o["cn"] / max(n, 1)
            support = (cosine or 0.0) + 0.1 * float(np.log(ratio))
            if clean and (ratio < RATIO_ALONE if cosine is None else support < LEAST_SUPPORT):
                continue
            scored.append((support - 0.3 * o["cost"], o["cn"], o["fix"]))
        return max(scored)[2] if scored else None

    def run(frames):
        for frame in frames:
            rows = []
            for i, at, raw, word, clean, n, options, decoded, context in frame[["intervention_id", "at", "raw", "word", "clean", "n", "options", "decoded", "context"]].itertuples(index=False):
                fix = decoded if options is None else chosen(word, bool(clean), int(n), options, [c.replace("\x1f", "") for c in context])
                if "\x1f" in raw:
                    rows.append((i, "join", raw, fix or word, at))
                if fix and fix != word:
                    rows.append((i, "char", word, fix, at))
            yield pd.DataFrame(rows, columns=["intervention_id", "kind", "raw", "fix", "at"])

    return run


def _texts(speeches: DataFrame) -> DataFrame:
    """(intervention_id, publication, speech_text) of the texts that are not blank."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in PUBLICATION if c in speeches.columns]
    rows = speeches.where(F.col("speech_text").isNotNull() & (F.trim("speech_text") != ""))
    return rows.select("intervention_id", F.concat_ws("\x1f", *parts).alias("publication"), "speech_text")


def find_repairs(speeches: DataFrame) -> DataFrame:
    """(intervention_id, kind, raw, fix, at) of every repair, one row for each occurrence of a word.

    Kinds: ``join`` (raw is left part, unit separator, right part; fix the
    whole word), ``char`` (raw the misread word), ``furniture`` (raw and fix the
    trimmed line). ``at`` is the place of the word among the words of its speech,
    from 0; furniture has none and is given once per speech. Null and blank texts
    give nothing, extra columns are ignored but those of ``PUBLICATION``, copies are
    treated alike; an empty table gives no rows.
    """
    texts = _texts(speeches)
    common, own = furniture_shapes(texts)
    o = own.select(F.col("publication").alias("_publication"), "own")
    paged = texts.join(o, F.col("publication") == F.col("_publication"), "left").select("intervention_id", "speech_text", "own")
    pages = materialize(paged.mapInPandas(_page_rows(common), "intervention_id long, furniture array<string>, words array<string>"), "pages")
    lines = pages.select("intervention_id", F.explode("furniture").alias("raw")).select("intervention_id", F.lit("furniture").alias("kind"), "raw", F.col("raw").alias("fix"), F.lit(None).cast("int").alias("at"))

    # Counts of all words; every distinct broken word then takes its better spelling.
    each = materialize(pages.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")), "counts")
    is_broken = F.col("word").contains("\x1f")
    unbroken = each.where(~is_broken)
    by_skeleton = unbroken.withColumn("skeleton", _skeleton_column(F.col("word"))).groupBy("skeleton").agg(F.max("n").alias("n"))
    pairs = each.where(is_broken).select(F.col("word").alias("raw"), F.col("n").alias("seen"))
    spelled = pairs.select("*", F.explode(F.array(F.struct(F.lit(0).alias("own"), F.replace("raw", F.lit("\x1f"), F.lit("")).alias("word")), F.struct(F.lit(1).alias("own"), F.replace("raw", F.lit("\x1f"), F.lit("-")).alias("word")))).alias("s")).select("raw", "seen", "s.own", "s.word")
    spelled = spelled.withColumn("skeleton", _skeleton_column(F.col("word"))).join(by_skeleton, "skeleton", "left")
    whole = materialize(spelled.groupBy("raw", "seen").agg(F.max_by("word", F.struct(F.coalesce("n", F.lit(0)), -F.col("own"))).alias("word")), "joined")

    counts = unbroken.unionByName(whole.groupBy("word").agg(F.sum("seen").alias("n"))).groupBy("word").agg(F.sum("n").alias("n"))
    fixes = materialize(corrections(counts), "fixes")
    total = int(each.agg(F.sum("n")).first()[0] or 0)
    least = max(TRUSTED_COUNT, int(TRUSTED_SHARE * total))
    # Trusted words need no correction; there are at most 1 / TRUSTED_SHARE of them, so they may be sent to every executor.
    trusted = [r.word for r in unbroken.where(F.col("n") >= least).join(fixes.select("word"), "word", "left_anti").select("word").collect()]
    suspects = pages.select("intervention_id", "words").mapInArrow(_suspects(trusted), "intervention_id long, at int, raw string, context array<string>")

    f = fixes.select(F.col("word").alias("_word"), "clean", "n", "options", "decoded")
    broken = F.col("raw").contains("\x1f")
    names = whole.select(F.col("raw").alias("_raw"), "word")
    suspects = materialize(suspects, "suspects")
    joined = suspects.where(broken).join(names, F.col("raw") == F.col("_raw")).drop("_raw").join(f, F.col("word") == F.col("_word"), "left")
    loose = suspects.where(~broken).withColumn("word", F.col("raw")).join(f, F.col("word") == F.col("_word"))
    vectors = learn_vectors(pages, each)
    told = joined.unionByName(loose).drop("_word").mapInPandas(_choose(vectors), "intervention_id long, kind string, raw string, fix string, at int")
    return lines.unionByName(materialize(told, "right"))


def _like(word: str, fix: str) -> str:
    """The fix with the capitals of the word as it stands."""
    if word.isupper() and len(word) > 1:
        return fix.upper()
    return fix[:1].upper() + fix[1:] if word[:1].isupper() else fix


def reflow(text: str, repairs: dict[str | tuple[int, str], str], furniture: set[str]) -> str:
    """Paragraphs of a text with furniture left out, broken words joined and misread words corrected.

    Repairs are keyed by place and raw word, or by the raw word for all its places.
    """
    _, paragraphs = read_page(text, {shape_key(f) for f in furniture})
    cores = _Cores()
    out = []
    at_word = 0  # counts the words as ``find_repairs`` does
    for paragraph in paragraphs:
        words = []
        for token in paragraph:
            plain, raw = token.replace("\x1f", ""), _word_of(token, cores)
            # A misread broken word has both a spelling and a correction; the joined form holds both.
            fix = repairs.get((at_word, raw)) or repairs.get(raw)
            at_word += raw != ""
            if fix:
                inner = plain.strip(_EDGES).rstrip("!").strip(_EDGES)
                at = plain.find(inner)
                plain = plain[:at] + _like(inner, fix) + plain[at + len(inner) :]
            words.append(plain)
        out.append(" ".join(words))
    return "\n\n".join(out)


def repair_texts(speeches: DataFrame) -> DataFrame:
    """(intervention_id, repaired_text): every speech as continuous paragraphs; null texts stay null."""
    found = find_repairs(speeches)
    own = found.groupBy("intervention_id").agg(F.collect_list(F.struct("kind", "raw", "fix", "at")).alias("repairs"))
    rows = speeches.select("intervention_id", "speech_text").join(own, "intervention_id", "left")

    def run(frames):
        for frame in frames:
            texts = []
            for text, repairs in zip(frame["speech_text"], frame["repairs"]):
                listed = list(repairs) if repairs is not None else []
                words = {(r["at"], r["raw"]): r["fix"] for r in listed if r["kind"] != "furniture"}
                texts.append(reflow(text, words, {r["raw"] for r in listed if r["kind"] == "furniture"}) if isinstance(text, str) else None)
            yield pd.DataFrame({"intervention_id": frame["intervention_id"], "repaired_text": texts})

    return rows.mapInPandas(run, "intervention_id long, repaired_text string")
