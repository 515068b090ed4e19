"""Queries of the problems on text corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almazara.llm import mixing, ocr, packing, spam, tokens
from almazara.runtime import table


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Joined words, corrected words and furniture lines of scanned speeches."""
    return ocr.find_repairs(table(spark, d, "intervenciones")).select("intervention_id", "kind", "fix").distinct()


def p5_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every speech as continuous, corrected paragraphs."""
    return ocr.repair_texts(table(spark, d, "intervenciones"))


def _capacities(spark: SparkSession, d: str) -> list[tuple[str, int]]:
    return [(r.pack_name, r.capacity_tokens) for r in table(spark, d, "pack_capacities").orderBy("pack_name").collect()]


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    """The container of every document (or piece of one) for every capacity."""
    return packing.pack_items(tokens.token_sizes(table(spark, d, "documents")), _capacities(spark, d))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    return packing.pack_report(p8_packed(spark, d), _capacities(spark, d))


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: documents packed, tokens lost or doubled, containers over the capacity, documents cut without need."""
    sizes, packs = tokens.token_sizes(table(spark, d, "documents")), _capacities(spark, d)
    capacity = table(spark, d, "pack_capacities")
    packed = packing.pack_items(sizes, packs).join(capacity, "pack_name")
    over = packed.groupBy("pack_name", "container_id").agg((F.sum("tokens") > F.first("capacity_tokens")).cast("long").alias("over")).groupBy("pack_name").agg(F.sum("over").alias("over_capacity"))
    by_document = packed.groupBy("pack_name", "capacity_tokens", "doc_id").agg(F.sum("tokens").alias("packed"), F.count("*").alias("pieces"))
    own = sizes.groupBy("doc_id").agg(F.sum("tokens").alias("own"), F.max("tokens").alias("longest"), F.count("*").alias("copies"))
    seen = by_document.join(own, "doc_id").groupBy("pack_name").agg(F.count("*").alias("documents"), F.sum(F.abs(F.col("packed") - F.col("own"))).alias("tokens_off"), F.sum(((F.col("longest") <= F.col("capacity_tokens")) & (F.col("pieces") > F.col("copies"))).cast("long")).alias("cut"))
    return seen.join(over, "pack_name").select("pack_name", "documents", "tokens_off", "over_capacity", "cut")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mixture, with pass and block."""
    return mixing.draw_mixture(tokens.token_sizes(table(spark, d, "documents")), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source."""
    sizes, targets = tokens.token_sizes(table(spark, d, "documents")), table(spark, d, "mix_targets")
    return mixing.mixture_report(mixing.draw_mixture(sizes, targets), sizes, targets)


def _tempered(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sizes, targets = tokens.token_sizes(table(spark, d, "documents")), table(spark, d, "mix_targets")
    return mixing.draw_mixture(sizes, targets, total_tokens=mixing.corpus_total(sizes, targets)), sizes, targets


def p9_tempered(spark: SparkSession, d: str) -> DataFrame:
    """The mixture of as many tokens as the corpus has, its weights bent by the exponent until the repetition limits hold."""
    return _tempered(spark, d)[0]


def p9_tempered_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source in the mixture of the corpus's size."""
    return mixing.mixture_report(*_tempered(spark, d))


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per source: whether its share is met within a document's size and no document is used too often."""
    sizes, targets = tokens.token_sizes(table(spark, d, "documents")), table(spark, d, "mix_targets")
    drawn = mixing.draw_mixture(sizes, targets)
    most = drawn.groupBy("source", "doc_id").agg(F.count("*").alias("used")).groupBy("source").agg(F.max("used").alias("used"))
    longest = sizes.groupBy("source").agg(F.max("tokens").alias("longest"))
    report = mixing.mixture_report(drawn, sizes, targets).join(most, "source", "left").join(longest, "source", "left")
    # The report has a row for each source of the targets.
    all_ = Window.partitionBy(F.lit(1))
    near = F.abs(F.col("actual_share") - F.col("target_share")) * F.sum("tokens_drawn").over(all_) <= 2 * F.max("longest").over(all_)
    return report.select("source", near.alias("share_met"), (F.coalesce("used", F.lit(0)) <= F.col("max_repeats")).alias("within_repeats"))


#: Entropy aimed at by ``p9_entropy``, in nats; nine even sources have 2.197.
ENTROPY = 2.0


def p9_entropy(spark: SparkSession, d: str) -> DataFrame:
    """The mixture of the tempered natural shares whose entropy is ``ENTROPY``, of as many tokens as the corpus has."""
    sizes, targets = tokens.token_sizes(table(spark, d, "documents")), table(spark, d, "mix_targets")
    return mixing.draw_mixture(sizes, targets, target_entropy=ENTROPY, total_tokens=mixing.corpus_total(sizes, targets))


def p10_scored(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its share of spam shapes."""
    return spam.page_scores(table(spark, d, "documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Pages of repeated keywords, lists of links or product tags."""
    return p10_scored(spark, d).where("flagged").select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p5_found, p5_repaired, p8_packed, p8_fill, p8_checks, p9_mixture, p9_shares, p9_checks, p9_tempered, p9_tempered_shares, p9_entropy, p10_found, p10_scored)}

#: What must hold of the results, as SQL can say it.
ORACLES = {
    "p8_checks": "SELECT pack_name, (SELECT count(DISTINCT doc_id) FROM documents WHERE text <> '') AS documents, CAST(0 AS BIGINT) AS tokens_off, CAST(0 AS BIGINT) AS over_capacity, CAST(0 AS BIGINT) AS cut FROM pack_capacities",
    "p9_checks": "SELECT source, true AS share_met, true AS within_repeats FROM mix_targets",
}
