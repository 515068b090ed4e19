"""N-Triples to the statement table.

Files are read and cut in one pass over Arrow batches, each file by one task; a line
whose IRI is wrapped waits for the next. Lines of any other frame are cut by JVM
regular expressions, and wrapped IRIs put together by an equi-join of the few open
lines with those that continue them.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almazara import schemas
from almazara.sources.archives import archive_lines

# The grammar of a statement whose escapes are masked, so that no group repeats over a long literal.
MASK = "\x01\x01"
RESOURCE = r"<[^>]*>|_:\S+"
STATEMENT = rf'^({RESOURCE})(\s*)(<[^>]*>)(\s*)(<[^>]*>|_:\S+|"[^"]*"(?:@\S+|\^\^<[^>]*>)?)\s*\.$'
SUFFIX = r'^"[^"]*"(?:@(\S+)|\^\^<([^>]*)>)?$'
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.S)
_SIMPLE = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def unescape(text: str) -> str | None:
    """Text with its escapes decoded; None where one is unknown or incomplete."""
    bad = False

    def one(m: re.Match) -> str:
        nonlocal bad
        e = m.group(1)
        if len(e) > 1:
            try:
                return chr(int(e[1:], 16))
            except ValueError:
                bad = True
                return ""
        if e not in _SIMPLE:
            bad = True
        return _SIMPLE.get(e, "")

    out = _ESCAPE.sub(one, text)
    return None if bad else out


def _unescaped(value: Column) -> Column:
    @F.pandas_udf("string")
    def decode(text: pd.Series) -> pd.Series:
        return text.map(lambda t: unescape(t) if isinstance(t, str) else None)

    return F.when(value.contains("\\"), decode(F.when(value.contains("\\"), value))).otherwise(value)


def logical_lines(lines: DataFrame) -> DataFrame:
    """Physical lines with wrapped IRIs put together, under the first line's number, and ``repaired``. WN-06, WN-07."""
    t = F.trim("value")
    opened = F.length(F.regexp_replace(t, "[^<]", "")) > F.length(F.regexp_replace(t, "[^>]", ""))
    is_open = opened & ~t.endswith(".") & ~t.startswith("#")
    keys = ["archive", "member"]
    heads = lines.where(is_open).select(*keys, "line_number", "value")
    tails = lines.where(t.startswith(">")).select(*keys, (F.col("line_number") - 1).alias("line_number"), F.ltrim("value").alias("tail"))
    joined = heads.join(tails, [*keys, "line_number"])
    whole = joined.select(*keys, "line_number", F.concat("value", "tail").alias("value"), F.lit(True).alias("repaired"))
    used = joined.select(*keys, F.explode(F.array("line_number", F.col("line_number") + 1)).alias("line_number"))
    suspects = lines.where(is_open | t.startswith(">")).join(used, [*keys, "line_number"], "left_anti")
    plain = lines.where(~(is_open | t.startswith(">")))
    return plain.unionByName(suspects).withColumn("repaired", F.lit(False)).unionByName(whole)


def parsed_statements(lines: DataFrame) -> DataFrame:
    """Logical lines with their terms and ``error``: null, ``ignored`` (blank or comment) or what is wrong. FN-24, FLT-05."""
    t = F.trim("value")
    masked = F.regexp_replace(t, r"\\.", MASK)
    g = lambda i: F.regexp_extract(masked, STATEMENT, i)
    size = lambda i: F.length(g(i))
    # The masked text has the same places as the text itself.
    part = lambda before, i: F.substring(t, sum((size(k) for k in before), F.lit(1)), size(i))
    obj, literal = part((1, 2, 3, 4), 5), g(5).startswith('"')
    suffix = lambda i: F.nullif(F.regexp_extract(g(5), SUFFIX, i), F.lit(""))
    closing = F.instr(F.substring(g(5), 2, 2**31 - 1), '"')
    inside = F.substring(obj, F.lit(2), closing - 1)
    resource = lambda c: _unescaped(F.when(c.startswith("<"), F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(c))
    good = masked.rlike(STATEMENT)
    rows = lines.select("*", F.when(good, resource(part((), 1))).alias("subject"), F.when(good, resource(part((1, 2), 3))).alias("predicate"), F.when(good, F.when(literal, _unescaped(inside)).otherwise(resource(obj))).alias("object"), F.when(good, F.when(literal, "literal").when(g(5).startswith("<"), "iri").otherwise("blank_node")).alias("object_kind"), F.when(good & literal, suffix(1)).alias("language"), F.when(good & literal, suffix(2)).alias("datatype"))
    missing = F.col("subject").isNull() | F.col("predicate").isNull() | F.col("object").isNull()
    error = F.when((t == "") | t.startswith("#"), "ignored").when(~t.endswith("."), "Triple must end with a period").when(~good, "Invalid statement").when(missing, "Invalid escape")
    rows = rows.withColumn("error", error)
    return rows.withColumns({c: F.when(F.col("error").isNull(), F.col(c)) for c in _COLUMNS[1:-1]})


_LINE = re.compile(r'\s*(<[^>]*>|_:\S+)\s*(<[^>]*>)\s*(?:(<[^>]*>)|(_:\S+)|"([^"\\]*(?:\\.[^"\\]*)*)"(?:@(\S+)|\^\^<([^>]*)>)?)\s*\.\s*\Z', re.S)
_COLUMNS = ["line_number", "subject", "predicate", "object", "object_kind", "language", "datatype", "error"]


def _terms(line: str) -> tuple:
    """(subject, predicate, object, kind, language, datatype, error) of one line."""
    m = _LINE.match(line)
    if m is None:
        t = line.strip()
        why = "ignored" if not t or t.startswith("#") else "Invalid statement" if t.endswith(".") else "Triple must end with a period"
        return (None,) * 6 + (why,)
    s, p, iri, blank, literal, language, datatype = m.groups()
    s, p = s[1:-1] if s[0] == "<" else s, p[1:-1]
    kind, o = ("iri", iri[1:-1]) if iri is not None else ("blank_node", blank) if blank is not None else ("literal", literal)
    if "\\" in line:
        s, p, o = unescape(s), unescape(p), unescape(o)
        if s is None or p is None or o is None:
            return (None,) * 6 + ("Invalid escape",)
    return s, p, o, kind, language or None, datatype or None, None


def _in_order(batches):
    """Statements of lines in physical order, wrapped IRIs put together; Arrow batches to Arrow batches."""
    import pyarrow as pa

    schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("line_number", pa.int64()), *[(c, pa.string()) for c in _COLUMNS[1:]], ("repaired", pa.bool_())])
    open_line: tuple | None = None  # archive, member, number, text of a line whose IRI is still open

    for batch in batches:
        rows = []
        for archive, member, number, line in zip(*(batch.column(c).to_pylist() for c in ("archive", "member", "line_number", "value"))):
            if open_line is not None:
                head, open_line = open_line, None
                if head[:2] == (archive, member) and head[2] + 1 == number and line.lstrip().startswith(">"):
                    rows.append((archive, member, head[2], *_terms(head[3] + line.lstrip()), True))
                    continue
                rows.append((*head[:3], *_terms(head[3]), False))
            got = _terms(line)
            if got[-1] == "Triple must end with a period" and line.count("<") > line.count(">"):
                open_line = (archive, member, number, line)
                continue
            rows.append((archive, member, number, *got, False))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    if open_line is not None:
        last = (*open_line[:3], *_terms(open_line[3]), False)
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(last, schema)], schema=schema)


def ordered_statements(lines: DataFrame) -> DataFrame:
    """``parsed_statements`` of ``archive_lines`` as they are read: one narrow pass, an open line kept till the next.

    Only for lines in physical order with whole members in one partition, as
    the archive source gives them; for other frames there is ``logical_lines``.
    """
    return lines.mapInArrow(_in_order, "archive string, member string, line_number long, subject string, predicate string, object string, object_kind string, language string, datatype string, error string, repaired boolean")


def statement_rows(statements: DataFrame, collection: str, snapshot: str) -> DataFrame:
    """Statement table of parsed lines without error. PRJ-02."""
    rows = statements.where(F.col("error").isNull())
    return schemas.conform(rows.select(F.concat(F.lit(collection), F.lit(":"), F.col("line_number").cast("string")).alias("record_id"), "subject", "predicate", "object", "object_kind", "language", "datatype", F.lit(collection).alias("collection"), F.col("line_number").alias("source_line"), F.lit(snapshot).cast("date").alias("snapshot_date")), "bne.triples")


def statement_summary(statements: DataFrame) -> DataFrame:
    """(parsed, ignored, invalid, repaired) of parsed lines. SNK-16."""
    e = F.col("error")
    return statements.agg(F.count_if(e.isNull()).alias("parsed"), F.count_if(e == "ignored").alias("ignored"), F.count_if(e.isNotNull() & (e != "ignored")).alias("invalid"), F.count_if("repaired").alias("repaired"))


def invalid_examples(statements: DataFrame, k: int = 20) -> DataFrame:
    """First k invalid lines. LM-07."""
    return statements.where(F.col("error").isNotNull() & (F.col("error") != "ignored")).orderBy("archive", "member", "line_number").select("line_number", "error").limit(k)


def read_statements(spark: SparkSession, paths: list[str], collection: str, snapshot: str) -> DataFrame:
    """Statement table of bzip2, gzip or plain files, strict UTF-8. SRC-10."""
    return statement_rows(ordered_statements(archive_lines(spark, paths)), collection, snapshot)
