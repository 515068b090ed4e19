"""Problem 4: attribute-value rows into wide tables of typed columns.

Values are read into the catalogue's types by JVM expressions and reduced to
one per (entity, column) with map-side combining, so a hot entity is a few dozen
cells before anything is grouped by entity. Entities are then grouped by their
characteristic set - the exact set of columns they have - and each set gets a
dense table of just its columns, however many sets there are: within every task
the entities are sorted by signature, each run of one signature becomes a dense
Arrow table, and the tables are united by name, missing columns allowed. A set
that holds most entities is spread over all tasks, and no plan grows with the
number of sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almazara.operators.timestamps import calendar_date, let
from almazara.runtime import materialize

# Words of numbers and of truth in Spanish.
NUMBER_WORDS = {w: n for n, w in enumerate("cero uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve veinte veintiuno veintidós veintitrés veinticuatro veinticinco veintiséis veintisiete veintiocho veintinueve".split())} | {"un": 1, "una": 1, "treinta": 30, "cuarenta": 40, "cincuenta": 50, "sesenta": 60, "setenta": 70, "ochenta": 80, "noventa": 90, "cien": 100, "ciento": 100, "doscientos": 200, "doscientas": 200, "trescientos": 300, "trescientas": 300, "cuatrocientos": 400, "cuatrocientas": 400, "quinientos": 500, "quinientas": 500, "seiscientos": 600, "seiscientas": 600, "setecientos": 700, "setecientas": 700, "ochocientos": 800, "ochocientas": 800, "novecientos": 900, "novecientas": 900}
TRUE_WORDS = ["true", "verdadero", "verdadera", "sí", "si", "s", "1", "yes"]
FALSE_WORDS = ["false", "falso", "falsa", "no", "n", "0"]

#: One number in digits: grouped thousands or plain, with a fraction or an exponent.
NUMBER = r"(?:\d{1,3}(?:[.  ]\d{3})++(?:,\d+)?+|\d++(?:[.,]\d++)?+(?:[eE][+-]?\d{1,2})?+)"
#: Signs that belong to no readable value: a doubt inside digits, a doubled separator, a range.
SPOILT = r"\d\s*+\?|\?\s*+\d|[.,]{2,}|\d\s*+[-/–]\s*+\d"
#: One date inside other words.
DATED = r"(?<!\d)(?:\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{4}|\d{1,2} de \p{L}+ del? \d{4})(?!\d)"
#: Signs that may stand around a value.
AROUND = " \t\r\n[](){}<>\"'«»"

#: Values of one multi-valued cell that the wide row carries; longer cells stand whole in ``multi_values``.
MAX_CELL_VALUES = 1000


def canonical_iri(iri: Column, prefixes: dict[str, str]) -> Column:
    """One way of writing an IRI: prefix expanded, http, scheme and host in lower case, no last slash, brackets or blanks."""
    bare = F.btrim(iri, F.lit(" \t\r\n<>"))
    expanded = lambda t: _first_prefix(t, prefixes)
    pattern = r"^(?i)(https?)://([^/]+)(.*)$"
    parts = lambda t: F.when(t.rlike(pattern), F.concat(F.lit("http://"), F.lower(F.regexp_extract(t, pattern, 2)), F.regexp_extract(t, pattern, 3))).otherwise(t)
    return let(F.rtrim(let(bare, expanded), F.lit("/")), parts)


def _first_prefix(t: Column, prefixes: dict[str, str]) -> Column:
    out = t
    for prefix, full in prefixes.items():
        rest = F.substring(t, len(prefix) + 2, 2**31 - 1)
        out = F.when((F.lower(F.substring(t, 1, len(prefix) + 1)) == f"{prefix}:".lower()) & ~rest.startswith("//"), F.concat(F.lit(full), rest)).otherwise(out)
    return out


def _single_number(text: Column, grouped: str) -> Column:
    """The one number in a text as plain digits with a point and its sign, or null.

    ``grouped``: pattern of a number whose points or blanks only group its digits.
    """
    found = F.regexp_extract_all(text, F.lit(f"({NUMBER})"), F.lit(1))
    sign = F.when(text.rlike(r"(?:^|[\s(\[])[-−]\s*+\d"), "-").otherwise("")
    ungrouped = lambda raw: F.when(raw.rlike(grouped), F.regexp_replace(raw, r"[.  ]", "")).otherwise(F.regexp_replace(raw, r"[  ]", ""))
    return let(found, lambda f: F.when((F.size(f) == 1) & ~text.rlike(SPOILT), F.concat(sign, F.replace(ungrouped(f[0]), F.lit(","), F.lit(".")))))


_NUMBER_WORD = "(?:" + "|".join(sorted([*NUMBER_WORDS, "mil"], key=lambda w: (-len(w), w))) + ")"
#: A run of number words between other words.
WORDED = rf"(?<!\p{{L}}){_NUMBER_WORD}(?:\s++(?:y\s++)?+{_NUMBER_WORD})*+(?!\p{{L}})"


def _worded_number(text: Column) -> Column:
    """The one number written in Spanish words (up to 999,999) in a text, or null.

    Other words may stand around it, but then ``un`` or ``una`` alone is an article.
    """
    lower = F.lower(text)
    known = F.create_map(*[F.lit(x) for pair in NUMBER_WORDS.items() for x in pair])
    total = lambda run: F.aggregate(F.filter(F.split(run, r"\s+"), lambda w: w != "y"), F.lit(0), lambda acc, w: F.when(w == "mil", F.greatest(acc, F.lit(1)) * 1000).otherwise(acc + F.try_element_at(known, w)))
    one = lambda f: F.when((F.size(f) == 1) & (~f[0].isin("un", "una") | (F.btrim(lower, F.lit(AROUND)) == f[0])), total(f[0]))
    return let(F.regexp_extract_all(lower, F.lit(f"({WORDED})"), F.lit(1)), one)


#: Points group digits in whole numbers; in decimals a single point is the decimal sign.
GROUPED_WHOLE = r"^\d{1,3}(?:[.  ]\d{3})++(?:,\d+)?$"
GROUPED_DECIMAL = r"^\d{1,3}(?:(?:\.\d{3}){2,}+(?:,\d+)?|(?:\.\d{3})++,\d+|(?:[  ]\d{3})++(?:,\d+)?)$"


def read_integer(text: Column) -> Column:
    """Whole number of a text with exactly one readable number, as digits; null otherwise, and beyond 38 digits."""
    whole = let(_single_number(text, GROUPED_WHOLE), lambda one: F.when(one.rlike(r"^-?\d+(\.0+)?$"), F.regexp_replace(one, r"\.0+$|(?<![\d.])0+(?=\d)", "")))
    plain = let(F.ltrim(F.btrim(text, F.lit(AROUND)), F.lit("0")), lambda t: F.when(t.rlike(r"^\d{1,38}$"), t))
    some = F.coalesce(plain, let(whole, lambda w: F.when(F.length(F.ltrim(w, F.lit("-"))) <= 38, w.cast("decimal(38,0)").cast("string"))))
    return F.when(text.rlike(r"\d"), some).otherwise(_worded_number(text).cast("string"))


def read_decimal(text: Column) -> Column:
    """Number of a text with a point and two digits (half up), or null; 36 digits before the point at most."""
    fits = lambda one: F.when(F.length(F.regexp_replace(one, r"^-|^-?0+|[.].*$", "")) <= 28, one)
    rounded = lambda one: F.when(one.rlike(r"^\d{1,28}\.\d{2}$"), one.cast("decimal(36,2)")).otherwise(fits(one).try_cast("decimal(38,10)").cast("decimal(36,2)"))
    value = F.when(text.rlike(r"\d"), let(_single_number(text, GROUPED_DECIMAL), rounded)).otherwise(_worded_number(text).cast("decimal(36,2)"))
    return value.cast("string")


def read_date(text: Column) -> Column:
    """Date of a text as yyyy-MM-dd, or null; a zone mark or a time beside the date changes nothing."""
    bare = F.btrim(text, F.lit(AROUND))
    year_first = r"^(\d{4})-(\d{2})-(\d{2})(?:Z|[+-]\d{2}:\d{2}|[T ][\d:.,]{5,}\s*(?:Z|[+-]\d{2}:?\d{2})?)?$"
    within = lambda t: let(F.regexp_extract_all(t, F.lit(f"({DATED})"), F.lit(1)), lambda f: F.when((F.size(f) == 1) & ~t.rlike(r"\?|\d{4}\s*[-–/]\s*\d{4}"), calendar_date(f[0])))
    other = lambda t: F.when(t.rlike(r"^\d{8}$|[-/.]|\sde\s") & ~t.rlike(r"\?"), F.coalesce(calendar_date(t), within(t)))
    written = lambda t: F.try_make_timestamp_ntz(F.substring(t, 1, 4).cast("int"), F.substring(t, 6, 2).cast("int"), F.substring(t, 9, 2).cast("int"), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")).cast("date")
    return let(bare, lambda t: F.when(t.rlike(year_first), written(t)).when(t.rlike(r"\d"), other(t))).cast("string")


def read_boolean(text: Column) -> Column:
    """``true`` or ``false`` of a text in digits or words of Spanish, or null."""
    bare = F.lower(F.btrim(text, F.lit(AROUND + ".")))
    return F.when(bare.isin(*TRUE_WORDS), "true").when(bare.isin(*FALSE_WORDS), "false")


def read_value(text: Column, kind: Column) -> Column:
    """Text of a value of type ``kind``, whatever the length of the text; null where it is not readable as that."""
    read = lambda t: F.when(t == "", None).when(kind == "integer", read_integer(t)).when(kind == "decimal", read_decimal(t)).when(kind == "date", read_date(t)).when(kind == "boolean", read_boolean(t)).otherwise(t)
    return let(F.trim(text), read)


def catalogued(triples: DataFrame, catalog: DataFrame, *, prefixes: dict[str, str], multi: bool) -> DataFrame:
    """(subject, object, source_line, record_id, column_name, column_type) of the rows in single- or multi-valued columns.

    The ways in which predicates are written are brought to one form once for each
    way, not for each row; those of the catalogue are written down, so that their
    size is known when the rows meet them.
    """
    c = catalog.where(F.col("multi_valued") if multi else ~F.coalesce("multi_valued", F.lit(False))).where(F.col("column_name").isNotNull())
    c = c.groupBy(canonical_iri(F.col("predicate"), prefixes).alias("_iri")).agg(F.min(F.struct("column_name", F.lower("column_type").alias("column_type"))).alias("c"))
    ways = triples.select("predicate").where(F.col("predicate").isNotNull()).distinct().select(F.col("predicate").alias("_way"), canonical_iri(F.col("predicate"), prefixes).alias("_iri"))
    ways = materialize(ways.join(c, "_iri").select("_way", "c.column_name", "c.column_type").coalesce(1), "ways")
    t = triples.where(F.col("subject").isNotNull() & F.col("object").isNotNull()).select("subject", F.col("predicate").alias("_predicate"), "object", "source_line", "record_id")
    return t.join(ways, F.col("_predicate") == F.col("_way")).drop("_predicate", "_way")


def typed_cells(triples: DataFrame, catalog: DataFrame, *, prefixes: dict[str, str], multi: bool) -> DataFrame:
    """(subject, column_name, column_type, source_line, record_id, value) of single- or multi-valued columns; value null where it is not readable.

    Rows with a null subject, predicate or object, or a predicate outside the
    catalogue, give nothing.
    """
    rows = catalogued(triples, catalog, prefixes=prefixes, multi=multi)
    return rows.select("subject", "column_name", "column_type", "source_line", "record_id", read_value(F.col("object"), F.col("column_type")).alias("value"))


def multi_values(triples: DataFrame, catalog: DataFrame, *, prefixes: dict[str, str]) -> DataFrame:
    """(subject, column_name, value) of multi-valued columns, every distinct value: the whole long form."""
    return typed_cells(triples, catalog, prefixes=prefixes, multi=True).select("subject", "column_name", "value").distinct().where(F.col("value").isNotNull())


#: Types of the wide table's columns; whole numbers may have more digits than a long holds.
TYPES = {"integer": "decimal(38,0)", "decimal": "decimal(36,2)", "date": "date", "boolean": "boolean"}


def entity_cells(triples: DataFrame, catalog: DataFrame, *, prefixes: dict[str, str], with_multi: bool = True) -> DataFrame:
    """(subject, signature, cells): the sorted names of the columns a subject has, and their cells in that order."""
    single = typed_cells(triples, catalog, prefixes=prefixes, multi=False)
    # Unreadable values have no rank; a filter before the aggregate would read every value twice.
    rank = F.when(F.col("value").isNotNull(), F.struct(F.coalesce("source_line", F.lit(-(2**62))), F.coalesce("record_id", F.lit("")), "value"))
    cells = single.groupBy("subject", "column_name").agg(F.max_by("value", rank).alias("value")).where(F.col("value").isNotNull()).select("subject", "column_name", "value", F.lit(None).cast("array<string>").alias("values"), F.lit(1).cast("long").alias("n"))
    if with_multi:
        many = multi_values(triples, catalog, prefixes=prefixes)
        # Long cells are told apart by their count before any array is built.
        counts = many.groupBy("subject", "column_name").agg(F.count("*").alias("n"))
        short = many.join(counts, ["subject", "column_name"]).where(F.col("n") <= MAX_CELL_VALUES).groupBy("subject", "column_name").agg(F.sort_array(F.collect_list("value")).alias("values"), F.first("n").alias("n"))
        long = counts.where(F.col("n") > MAX_CELL_VALUES).select("subject", "column_name", F.lit(None).cast("array<string>").alias("values"), "n")
        cells = cells.unionByName(short.unionByName(long).withColumn("value", F.lit(None).cast("string")))
    # A subject has at most one cell of each column of the catalogue, whatever its number of rows.
    entities = cells.groupBy("subject").agg(F.array_sort(F.collect_list(F.struct("column_name", "value", "values", "n"))).alias("cells"))
    return entities.select("subject", F.col("cells.column_name").alias("signature"), "cells")


def _dense_tables(schema: pa.Schema, multi: frozenset[str]):
    """A function for mapInArrow: runs of one signature to dense tables, united by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signatures = batch.column("signature")
            flat = batch.column("cells").flatten()
            parts = {name: flat.field(name) for name in ("value", "values", "n")}
            tables, row, at = [schema.empty_table()], 0, 0
            for names, same in groupby(signatures.to_pylist()):
                rows, width = sum(1 for _ in same), len(names)
                # The dense table of a characteristic set: just its columns, no cell of which is missing.
                columns = {"subject": batch.column("subject").slice(row, rows), "signature": signatures.slice(row, rows)}
                for i, name in enumerate(names):
                    cell = pa.array(range(at + i, at + rows * width, width), pa.int64())
                    if name in multi:
                        columns |= {name: parts["values"].take(cell), f"{name}_count": parts["n"].take(cell)}
                    else:
                        columns[name] = parts["value"].take(cell)
                tables.append(pa.table({k: v.cast(schema.field(k).type) for k, v in columns.items() if k in schema.names}))
                row, at = row + rows, at + rows * width
            yield from pa.concat_tables(tables, promote_options="default").combine_chunks().to_batches()

    return run


def wide_entities(triples: DataFrame, catalog: DataFrame, *, prefixes: dict[str, str], with_multi: bool = True) -> DataFrame:
    """One row per subject with at least one readable cell, in typed columns of the catalogue.

    Of several readable values of a single-valued cell the one with the greatest
    source_line stands (ties: greatest record_id, then value; a null line is
    least). Multi-valued columns are sorted arrays of distinct values with a
    ``<column>_count``; a cell of more than ``MAX_CELL_VALUES`` values has its
    count here and its values in ``multi_values``. Further columns: ``signature``,
    the sorted names of the columns the subject has. An empty table gives no rows.
    """
    # The catalogue names the columns of one table: a few dozen rows by its nature.
    listed = {r.column_name: ((r.column_type or "string").lower(), bool(r.multi_valued)) for r in catalog.where(F.col("column_name").isNotNull()).orderBy(F.desc("column_name"), F.desc("predicate")).collect()}
    columns = [(n, kind, m) for n, (kind, m) in sorted(listed.items()) if with_multi or not m]
    entities = entity_cells(triples, catalog, prefixes=prefixes, with_multi=any(m for _, _, m in columns))
    fields = [T.StructField("subject", T.StringType()), T.StructField("signature", T.ArrayType(T.StringType()))]
    for name, _, is_multi in columns:
        fields += [T.StructField(name, T.ArrayType(T.StringType()) if is_multi else T.StringType())]
        fields += [T.StructField(f"{name}_count", T.LongType())] if is_multi else []
    plain = lambda t: pa.list_(pa.string()) if isinstance(t, T.ArrayType) else pa.int64() if isinstance(t, T.LongType) else pa.string()
    schema = pa.schema([(f.name, plain(f.dataType)) for f in fields])
    multi = frozenset(n for n, _, m in columns if m)
    dense = entities.sortWithinPartitions("signature").mapInArrow(_dense_tables(schema, multi), T.StructType(fields))
    typed = []
    for name, kind, is_multi in columns:
        typed += [F.col(name), F.coalesce(f"{name}_count", F.lit(0).cast("long")).alias(f"{name}_count")] if is_multi else [F.col(name).cast(TYPES.get(kind, "string")).alias(name)]
    return dense.select("subject", "signature", *typed)


def characteristic_sets(triples: DataFrame, catalog: DataFrame, *, prefixes: dict[str, str]) -> DataFrame:
    """(signature, subjects): every exact set of columns and how many subjects have it."""
    return entity_cells(triples, catalog, prefixes=prefixes).groupBy("signature").agg(F.count("*").alias("subjects"))


def cells_of(wide: DataFrame, catalog: DataFrame, kinds: list[str]) -> DataFrame:
    """(subject, column_name, cell_value) of the non-null single-valued cells of the given types."""
    names = [r.column_name for r in catalog.where(F.lower("column_type").isin(*kinds) & ~F.coalesce("multi_valued", F.lit(False))).orderBy("column_name").collect()]
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).cast("string").alias("cell_value")) for n in names])
    return wide.select("subject", F.explode(pairs).alias("c")).where(F.col("c.cell_value").isNotNull()).select("subject", "c.column_name", "c.cell_value")
