"""Queries that show the engine's operators on the project's tables, each with the SQL of the same result.

Names begin with the class of operator: ag (aggregates), jn (joins), wn (row order),
so (sets), flt (filters), ns (nested data), fn (functions), dq (quality), pln (planning),
lm (top-k), src and snk (tables in and out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almazara.functions import ids, numbers, temporal, text
from almazara.operators import planning, profile, quality, relational
from almazara.runtime import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def registrar(queries: dict, oracles: dict):
    """A decorator that registers a query, and its SQL where SQL can say it."""

    def query(sql: str | None = None):
        def register(f):
            queries[f.__name__] = f
            if sql is not None:
                oracles[f.__name__] = sql
            return f

        return register

    return query


query = registrar(QUERIES, ORACLES)


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _profile_sql(column: str, kind: str, t: str) -> str:
    num = kind == "num"
    x = f"CAST({column} AS DOUBLE)" if num else "NULL::DOUBLE"
    n = "NULL::INTEGER" if num else f"length({column})"
    return f"SELECT '{column}' AS \"column\", count(*) AS \"rows\", count(*) - count({column}) AS nulls, count(DISTINCT {column}) AS distinct_values, min({x}) AS minimum, max({x}) AS maximum, round(avg({x}), 4) AS mean, CAST(min({n}) AS INTEGER) AS min_length, CAST(max({n}) AS INTEGER) AS max_length, round(avg(CAST({n} AS DOUBLE)), 4) AS mean_length, round((count(*) - count({column})) / count(*), 8) AS null_fraction FROM {t}"


@query(" UNION ALL ".join(_profile_sql(c, "num" if c in ("o_orderkey", "o_custkey", "o_totalprice") else "text", "orders") for c in ORDER_COLUMNS))
def ag01_column_profile(spark: SparkSession, d: str) -> DataFrame:
    """Full column profile."""
    out = profile.column_profile(table(spark, d, "orders"), ORDER_COLUMNS)
    return out.withColumn("mean", F.round("mean", 4)).withColumn("mean_length", F.round("mean_length", 4))


@query("SELECT \"column\", value, n, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, value) AS place FROM (SELECT 'p_brand' AS \"column\", p_brand AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY 2)) WHERE place <= 20")
def ag01_top_values(spark: SparkSession, d: str) -> DataFrame:
    """Twenty most frequent values of each column."""
    return profile.top_values(table(spark, d, "part"), ["p_brand", "p_type"], 20)


@query("SELECT 'props' AS \"column\", count(*) AS \"rows\", count(*) - count(props) AS nulls, CASE WHEN count(DISTINCT props) <= 50 THEN count(DISTINCT props) END AS distinct_values, CASE WHEN count(DISTINCT props) > 50 THEN 51::BIGINT END AS distinct_lower_bound FROM events UNION ALL SELECT 'event_type', count(*), count(*) - count(event_type), count(DISTINCT event_type), NULL FROM events")
def ag02_bounded_profile(spark: SparkSession, d: str) -> DataFrame:
    """Column profile with a capped distinct count."""
    return profile.column_profile(table(spark, d, "events"), ["props", "event_type"], distinct_cap=50).select("column", "rows", "nulls", "distinct_values", "distinct_lower_bound")


@query("SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 5")
def ag02_samples(spark: SparkSession, d: str) -> DataFrame:
    """First five present values by key."""
    return profile.samples(table(spark, d, "events"), "event_type", "event_id", 5)


@query("SELECT count(*) AS triples, count(DISTINCT subject) AS subjects, count(DISTINCT predicate) AS predicates, count(DISTINCT object) AS objects, count(*) FILTER (WHERE object_kind = 'iri') AS iris, count(*) FILTER (WHERE object_kind = 'literal') AS literals, count(*) FILTER (WHERE object_kind = 'blank_node') AS blank_nodes, count(*) FILTER (WHERE language IS NOT NULL) AS with_language, count(*) FILTER (WHERE datatype IS NOT NULL) AS with_datatype, min(source_line) AS first_line, max(source_line) AS last_line FROM triples")
def ag03_global_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts, distinct counts and conditional counts of statements in one aggregate."""
    t = table(spark, d, "triples")
    kind = lambda k: F.count_if(F.col("object_kind") == k)
    return t.agg(F.count("*").alias("triples"), F.count_distinct("subject").alias("subjects"), F.count_distinct("predicate").alias("predicates"), F.count_distinct("object").alias("objects"), kind("iri").alias("iris"), kind("literal").alias("literals"), kind("blank_node").alias("blank_nodes"), F.count("language").alias("with_language"), F.count("datatype").alias("with_datatype"), F.min("source_line").alias("first_line"), F.max("source_line").alias("last_line"))


@query("SELECT predicate AS value, count(*) AS n FROM triples WHERE predicate IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 30")
def ag04_top_predicates(spark: SparkSession, d: str) -> DataFrame:
    """Thirty most used predicates."""
    return profile.value_counts(table(spark, d, "triples"), "predicate", 30)


@query("SELECT event_type AS value, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def ag05_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """Value counts without nulls."""
    return profile.value_counts(table(spark, d, "events"), "event_type")


@query("SELECT count(*) AS n, min(value) AS minimum, max(value) AS maximum, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM events WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)")
def ag06_numeric_summary(spark: SparkSession, d: str) -> DataFrame:
    """Count, extremes, mean and population deviation."""
    return profile.numeric_summary(table(spark, d, "events"), "value")


@query("SELECT count(*) AS n, min(price) AS minimum, max(price) AS maximum, round(avg(price), 6) AS mean, round(stddev_pop(price), 6) AS std FROM day_ahead_prices WHERE price IS NOT NULL AND NOT isnan(price) AND NOT isinf(price)")
def ag07_price_summary(spark: SparkSession, d: str) -> DataFrame:
    """Price summary, non-finite values left out."""
    return profile.numeric_summary(table(spark, d, "day_ahead_prices"), "price")


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def ag08_year_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Rows per year."""
    return profile.year_histogram(table(spark, d, "orders"), "o_orderdate")


@query("SELECT l_linestatus AS value, CASE l_linestatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'unknown' END AS label, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 4) AS percent FROM lineitem GROUP BY 1")
def ag09_shares(spark: SparkSession, d: str) -> DataFrame:
    """Share of each status with its label."""
    return profile.shares(table(spark, d, "lineitem"), "l_linestatus", {"O": "open", "F": "filled"})


COVERAGE = ["language", "datatype", "object"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, count({c}) AS present, round(count({c}) * 100.0::DOUBLE / count(*), 4) AS percent FROM triples" for c in COVERAGE))
def ag10_field_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Present values of each field."""
    return profile.field_coverage(table(spark, d, "triples"), COVERAGE)


@query("SELECT min(l_shipdate) AS min_shipped, max(l_shipdate) AS max_shipped FROM lineitem")
def ag11_time_extent(spark: SparkSession, d: str) -> DataFrame:
    """First and last times."""
    return profile.extent(table(spark, d, "lineitem"), {"shipped": "l_shipdate"})


@query("SELECT CAST(sum(n) AS BIGINT) AS \"rows\", count(*) AS keys, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM day_ahead_prices GROUP BY record_id)")
def ag12_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences of a record id after its first."""
    return profile.duplicate_count(table(spark, d, "day_ahead_prices"), ["record_id"])


@query("SELECT min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon, max(longitude) AS max_lon FROM sites")
def ag13_extent(spark: SparkSession, d: str) -> DataFrame:
    """Bounding box of the sites."""
    return profile.extent(table(spark, d, "sites"), {"lat": "latitude", "lon": "longitude"})


@query("SELECT count(*) AS \"rows\", count(*) FILTER (WHERE price < 0) AS negative, count(*) FILTER (WHERE price IS NULL) AS empty, count(*) FILTER (WHERE revision_number > 1) AS revised FROM day_ahead_prices")
def ag14_conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows under conditions."""
    c = F.col
    return profile.conditional_counts(table(spark, d, "day_ahead_prices"), {"negative": c("price") < 0, "empty": c("price").isNull(), "revised": c("revision_number") > 1})


@query("SELECT 'autor' AS \"column\", count(DISTINCT autor) FILTER (WHERE autor <> '') AS distinct_values FROM intervenciones UNION ALL SELECT 'orador', count(DISTINCT orador) FILTER (WHERE orador <> '') FROM intervenciones UNION ALL SELECT 'num_expediente', count(DISTINCT num_expediente) FILTER (WHERE num_expediente <> '') FROM intervenciones")
def ag15_distinct_present(spark: SparkSession, d: str) -> DataFrame:
    """Distinct values, empty texts left out."""
    return profile.distinct_present(table(spark, d, "intervenciones"), ["autor", "orador", "num_expediente"])


@query("SELECT organo, count(length(speech_text)) AS \"rows\", CAST(coalesce(sum(length(speech_text)), 0) AS BIGINT) AS total, CAST(CASE WHEN count(speech_text) > 0 THEN sum(length(speech_text)) // count(speech_text) ELSE 0 END AS BIGINT) AS mean FROM intervenciones GROUP BY 1")
def ag16_floor_mean(spark: SparkSession, d: str) -> DataFrame:
    """Whole-number mean length of speeches by body."""
    t = table(spark, d, "intervenciones").select("organo", F.char_length("speech_text").alias("chars"))
    return profile.floor_mean(t, "organo", "chars")


@query("SELECT row_number() OVER (ORDER BY value) - 1 AS position, value FROM (SELECT DISTINCT parliamentary_group AS value FROM deputy_votes WHERE parliamentary_group IS NOT NULL)")
def ag17_sorted_groups(spark: SparkSession, d: str) -> DataFrame:
    """Parliamentary groups in order."""
    return profile.sorted_distinct(table(spark, d, "deputy_votes"), "parliamentary_group")


@query("SELECT coalesce(surface, 'unassigned') AS bucket, count(*) AS n FROM measurements GROUP BY 1")
def ag18_unassigned(spark: SparkSession, d: str) -> DataFrame:
    """Counts with nulls under a name."""
    return profile.bucket_counts(table(spark, d, "measurements"), "surface")


VOTES = ["Sí", "No", "Abstención"]


@query("SELECT parliamentary_group, " + ", ".join(f"count(*) FILTER (WHERE vote = '{v}') AS \"{v}\"" for v in VOTES) + " FROM deputy_votes GROUP BY 1")
def ag19_vote_cross_tab(spark: SparkSession, d: str) -> DataFrame:
    """Votes by group."""
    return profile.cross_tab(table(spark, d, "deputy_votes"), "parliamentary_group", "vote", VOTES)


@query("SELECT count(*) AS \"rows\", CAST(count(*) * 3 - count(seat) - count(vote) - count(parliamentary_group) AS BIGINT) AS required_nulls FROM deputy_votes")
def ag20_required_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Nulls over required columns."""
    return profile.null_counts(table(spark, d, "deputy_votes"), ["seat", "vote", "parliamentary_group"])


@query("SELECT * FROM (SELECT 'triples' AS table_name, count(*) AS n FROM triples UNION ALL SELECT 'zones', count(*) FROM zones UNION ALL SELECT 'total', (SELECT count(*) FROM triples) + (SELECT count(*) FROM zones))")
def ag21_totals(spark: SparkSession, d: str) -> DataFrame:
    """Rows of several tables and in all."""
    return profile.totals({n: table(spark, d, n).agg(F.count("*").alias("rows")) for n in ("triples", "zones")})


@query("SELECT zone_key, count(*) AS records, round(count(*) * 64.0::DOUBLE / 1048576, 6) AS estimated_mb FROM day_ahead_prices GROUP BY 1")
def ag22_estimates(spark: SparkSession, d: str) -> DataFrame:
    """Estimated size by zone at 64 bytes a record."""
    t = table(spark, d, "day_ahead_prices").groupBy("zone_key").agg(F.count("*").alias("records"))
    return t.withColumn("estimated_mb", F.round(F.col("records") * 64.0 / 1048576, 6))


@query("SELECT count(*) AS \"rows\", CAST(sum(CASE WHEN k > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_rows, CAST(sum(CASE WHEN o THEN 1 ELSE 0 END) AS BIGINT) AS out_of_range_rows FROM (SELECT row_number() OVER (PARTITION BY record_id) AS k, NOT (timestamp_utc >= TIMESTAMPTZ '2026-05-05 00:00:00+00' AND timestamp_utc < TIMESTAMPTZ '2026-06-01 00:00:00+00') AS o FROM day_ahead_prices)")
def ag23_removal_counts(spark: SparkSession, d: str) -> DataFrame:
    """Duplicate and out-of-range rows of a normalisation."""
    t = table(spark, d, "day_ahead_prices")
    inside = (F.col("timestamp_utc") >= F.lit("2026-05-05T00:00:00Z").cast("timestamp")) & (F.col("timestamp_utc") < F.lit("2026-06-01T00:00:00Z").cast("timestamp"))
    keys = t.groupBy("record_id").agg(F.count("*").alias("n"), F.count_if(~inside).alias("outside"))
    return keys.agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicate_rows"), F.sum("outside").alias("out_of_range_rows"))


@query("SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def jn01_matched(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their customers."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), "o_totalprice")
    return relational.matched(o, table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_name"), ["k"]).drop("k")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def jn02_pending(spark: SparkSession, d: str) -> DataFrame:
    """Customers without orders."""
    return relational.pending(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT p_partkey, coalesce(m, p_retailprice) AS p_retailprice, CASE WHEN m IS NULL THEN 'base' ELSE 'override' END AS p_retailprice_from FROM part LEFT JOIN (SELECT l_partkey, max(l_extendedprice / l_quantity) AS m FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON p_partkey = l_partkey")
def jn03_overridden(spark: SparkSession, d: str) -> DataFrame:
    """Part prices replaced where a returned line has one."""
    new = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("p_retailprice"))
    return relational.overridden(table(spark, d, "part").select("p_partkey", "p_retailprice"), new, "p_partkey", "p_retailprice")


@query("SELECT zone_key, coalesce(z.name, '') AS name, n FROM (SELECT zone_key, count(*) AS n FROM day_ahead_prices GROUP BY 1) LEFT JOIN zones z USING (zone_key)")
def jn05_zone_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Price counts with zone names, blank where unknown."""
    counts = table(spark, d, "day_ahead_prices").groupBy("zone_key").agg(F.count("*").alias("n"))
    return relational.with_attributes(counts, table(spark, d, "zones").select("zone_key", "name"), ["zone_key"], {"name": ""})


@query("SELECT o_orderkey, quarter FROM orders JOIN (SELECT strftime(s, '%Y') || '-' || CAST(quarter(s) AS VARCHAR) AS quarter, s AS q_start, s + INTERVAL 3 MONTH AS q_end FROM (SELECT unnest(generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2030-10-01', INTERVAL 3 MONTH)) AS s)) ON o_orderdate >= q_start AND o_orderdate < q_end")
def jn06_half_open_interval(spark: SparkSession, d: str) -> DataFrame:
    """The quarter [start, end) of each order, met by year."""
    q = spark.range(1).select(F.explode(F.expr("sequence(timestamp_ntz'1990-01-01', timestamp_ntz'2030-10-01', interval 3 month)")).alias("q_start"))
    q = q.select(F.year("q_start").alias("y"), "q_start", (F.col("q_start") + F.expr("interval 3 month")).alias("q_end"), F.concat_ws("-", F.year("q_start"), F.quarter("q_start")).alias("quarter"))
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("y"))
    return relational.within(o, q, "o_orderdate", "q_start", "q_end", on=["y"]).select("o_orderkey", "quarter")


@query("WITH z AS (SELECT zone_key, coalesce(TRY_CAST(valid_from AS DATE), DATE '2025-01-01') AS f, coalesce(TRY_CAST(valid_to AS DATE), DATE '2026-07-01') AS t FROM zones), g AS (SELECT d AS kind, zone_key, f, t, CAST(b AS DATE) AS b FROM z, (SELECT unnest(['day_ahead_prices', 'actual_load']) AS d), (SELECT unnest(generate_series(DATE '2025-01-01', DATE '2026-06-30', INTERVAL 1 MONTH)) AS b)) SELECT kind, zone_key, greatest(b, f, DATE '2025-01-01') AS period_start, least(CAST(b + INTERVAL 1 MONTH AS DATE), t, DATE '2026-07-01') AS period_end FROM g WHERE greatest(b, f) < least(CAST(b + INTERVAL 1 MONTH AS DATE), t, DATE '2026-07-01')")
def pln01_task_grid(spark: SparkSession, d: str) -> DataFrame:
    """Monthly download tasks clipped to each zone's validity."""
    return planning.task_grid(table(spark, d, "zones"), ["day_ahead_prices", "actual_load"], "2025-01-01", "2026-07-01")


@query("SELECT a.subject, a.object AS via, b.object, a.predicate AS first_predicate, b.predicate AS second_predicate FROM triples a JOIN triples b ON a.object = b.subject WHERE a.object_kind = 'iri'")
def jn13_two_hop(spark: SparkSession, d: str) -> DataFrame:
    """Paths of two statements."""
    return relational.two_hop(table(spark, d, "triples"), leads=F.col("object_kind") == "iri")


@query("SELECT i.intervention_id, t.title FROM intervenciones i JOIN initiatives t ON i.num_expediente = t.expediente WHERE i.num_expediente <> ''")
def jn14_parent_child(spark: SparkSession, d: str) -> DataFrame:
    """Speeches with the ballots of their file."""
    i = table(spark, d, "intervenciones").where(F.col("num_expediente") != "").select("intervention_id", F.col("num_expediente").alias("expediente"))
    return relational.matched(i, table(spark, d, "initiatives").select("expediente", "title"), ["expediente"]).drop("expediente")


@query("SELECT a.site_id AS left_id, b.site_id AS right_id FROM sites a JOIN sites b ON a.latitude - 0.5 <= b.latitude + 0.5 AND b.latitude - 0.5 <= a.latitude + 0.5 AND a.longitude - 0.5 <= b.longitude + 0.5 AND b.longitude - 0.5 <= a.longitude + 0.5")
def jn15_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Sites whose boxes of one degree meet."""
    s = table(spark, d, "sites").select(F.col("site_id").alias("id"), (F.col("longitude") - 0.5).alias("min_x"), (F.col("latitude") - 0.5).alias("min_y"), (F.col("longitude") + 0.5).alias("max_x"), (F.col("latitude") + 0.5).alias("max_y"))
    return relational.boxes_meeting(s, s, 2.0)


@query("SELECT o_custkey, max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS \"O\", max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS \"F\", max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS \"P\" FROM orders GROUP BY 1")
def jn11_pivot_merge(spark: SparkSession, d: str) -> DataFrame:
    """Greatest order of each status per customer."""
    return relational.pivot_merge(table(spark, d, "orders"), "o_custkey", "o_orderstatus", "o_totalprice", ["O", "F", "P"])


@query("SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def wn01_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """First event of each user and type."""
    return relational.keep_first(table(spark, d, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])


@query("SELECT record_id, revision_number, price, document_id FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY revision_number DESC NULLS LAST, document_id DESC NULLS LAST, timeseries_id DESC NULLS LAST, price DESC NULLS LAST) AS k FROM (SELECT record_id, revision_number, CASE WHEN isnan(price) THEN NULL ELSE price END AS price, document_id, timeseries_id FROM day_ahead_prices)) WHERE k = 1")
def wn03_latest_revision(spark: SparkSession, d: str) -> DataFrame:
    """Last revision of each price record, empty prices kept."""
    t = table(spark, d, "day_ahead_prices").select("record_id", "revision_number", F.when(~F.isnan("price"), F.col("price")).alias("price"), "document_id", "timeseries_id")
    order = [F.col(c) for c in ("revision_number", "document_id", "timeseries_id", "price")]
    return relational.latest_version(t, ["record_id"], order).drop("timeseries_id")


@query("SELECT vec_id, CAST(p - 1 AS INTEGER) AS position, embedding[p] AS item FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)")
def wn04_positions(spark: SparkSession, d: str) -> DataFrame:
    """Elements of vectors with their position from 0."""
    return relational.positions(table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS shard FROM orders")
def wn08_shards(spark: SparkSession, d: str) -> DataFrame:
    """Shards of exactly 1,000 orders."""
    return relational.numbered_shards(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 1000).select("o_orderkey", "shard")


@query("SELECT l_shipmode_year AS y, l_orderkey, l_linenumber FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS l_shipmode_year, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY year(l_shipdate) ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k <= 3")
def lm01_top_k_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Three dearest lines of each year."""
    from pyspark.sql import Window

    t = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("y"), "l_orderkey", "l_linenumber", "l_extendedprice")
    k = F.row_number().over(Window.partitionBy("y").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"))
    return t.withColumn("k", k).where("k <= 3").select("y", "l_orderkey", "l_linenumber")


@query("SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL ORDER BY 1 LIMIT 10")
def lm06_first_distinct(spark: SparkSession, d: str) -> DataFrame:
    """First ten part types in order."""
    return relational.first_distinct(table(spark, d, "part"), "p_type", 10)


@query("SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def so01_in_both(spark: SparkSession, d: str) -> DataFrame:
    """Nations of both customers and suppliers."""
    return relational.in_both(table(spark, d, "customer").select("c_nationkey"), table(spark, d, "supplier").select(F.col("s_nationkey").alias("c_nationkey")))


@query("SELECT zone_key FROM zones EXCEPT SELECT zone_key FROM day_ahead_prices")
def so02_missing(spark: SparkSession, d: str) -> DataFrame:
    """Zones without prices."""
    return relational.missing_from(table(spark, d, "zones").select("zone_key"), table(spark, d, "day_ahead_prices").select("zone_key"))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation")
def so03_distinct_union(spark: SparkSession, d: str) -> DataFrame:
    """Nations anywhere."""
    return relational.distinct_union([table(spark, d, n).select(F.col(c).alias("k")) for n, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))])


@query("SELECT c_custkey AS k, c_acctbal AS balance, NULL AS size, 'customer' AS source_format FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, 'supplier' FROM supplier UNION ALL SELECT p_partkey, NULL, p_size, 'part' FROM part")
def so04_tagged_union(spark: SparkSession, d: str) -> DataFrame:
    """Union by name of unlike tables with their origin."""
    return relational.tagged_union({"customer": table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance")), "supplier": table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("balance")), "part": table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("size"))}).select("k", "balance", "size", "source_format")


@query("SELECT record_id, epoch_us(timestamp_utc) AS at_us, CASE WHEN isnan(price) THEN NULL ELSE price END AS price FROM day_ahead_prices WHERE timestamp_utc >= TIMESTAMPTZ '2026-05-30 00:00:00+00' AND timestamp_utc < TIMESTAMPTZ '2026-06-01 00:00:00+00'")
def flt01_interval(spark: SparkSession, d: str) -> DataFrame:
    """Prices of a half-open interval, pushed to the scan; no number is null."""
    t = F.col("timestamp_utc")
    inside = (t >= F.lit("2026-05-30T00:00:00Z").cast("timestamp")) & (t < F.lit("2026-06-01T00:00:00Z").cast("timestamp"))
    return table(spark, d, "day_ahead_prices").where(inside).select("record_id", F.unix_micros("timestamp_utc").alias("at_us"), F.when(~F.isnan("price"), F.col("price")).alias("price"))


@query("SELECT record_id FROM day_ahead_prices WHERE coalesce(contract_type, 'A01') = 'A01'")
def flt02_contract(spark: SparkSession, d: str) -> DataFrame:
    """Prices of the contract kept, null included."""
    return table(spark, d, "day_ahead_prices").where(F.coalesce("contract_type", F.lit("A01")) == "A01").select("record_id")


@query("SELECT raw_id, value FROM raw_captures WHERE value IS NOT NULL AND value <> -9999")
def flt03_sentinel(spark: SparkSession, d: str) -> DataFrame:
    """Values without the sentinel."""
    return table(spark, d, "raw_captures").where(F.col("value").isNotNull() & (F.col("value") != -9999)).select("raw_id", "value")


@query("SELECT intervention_id, tipo_intervencion FROM intervenciones WHERE organo = 'Pleno' AND fase = 'Debate de totalidad'")
def flt08_equality(spark: SparkSession, d: str) -> DataFrame:
    """Speeches of a body and phase."""
    return table(spark, d, "intervenciones").where((F.col("organo") == "Pleno") & (F.col("fase") == "Debate de totalidad")).select("intervention_id", "tipo_intervencion")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE props IS NOT NULL")
def prj06_json_field(spark: SparkSession, d: str) -> DataFrame:
    """Field of JSON properties."""
    return table(spark, d, "events").where(F.col("props").isNotNull()).select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT o_orderkey, CAST(d AS DATE) AS day FROM (SELECT o_orderkey, unnest(generate_series(date_trunc('month', o_orderdate), last_day(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)")
def fn13_days_of_month(spark: SparkSession, d: str) -> DataFrame:
    """One row per day of the order's month."""
    t = table(spark, d, "orders")
    month = F.trunc("o_orderdate", "month")
    return t.select("o_orderkey", F.explode(F.sequence(month, F.last_day("o_orderdate"))).alias("day"))


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[\s ]+', ' ', 'g')) AS plain FROM documents")
def fn01_strip_html(spark: SparkSession, d: str) -> DataFrame:
    """Texts without tags, spaces to one."""
    return table(spark, d, "documents").select("doc_id", text.strip_tags(F.col("text")).alias("plain"))


@query("SELECT raw_id, TRY_CAST(replace(trim(replace(CAST(value AS VARCHAR), '.', ',')), ',', '.') AS DOUBLE) AS number FROM raw_captures")
def fn03_lenient_float(spark: SparkSession, d: str) -> DataFrame:
    """Numbers with comma or point."""
    t = table(spark, d, "raw_captures")
    return t.select("raw_id", numbers.lenient_double(F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))).alias("number"))


@query(r"SELECT record_id, CASE WHEN regexp_full_match(trim(object), '[+-]?[0-9]+') THEN TRY_CAST(trim(object) AS BIGINT) END AS whole FROM triples")
def fn05_strict_integer(spark: SparkSession, d: str) -> DataFrame:
    """Objects that are whole numbers and nothing else."""
    return table(spark, d, "triples").select("record_id", numbers.strict_long(F.col("object")).alias("whole"))


@query("SELECT raw_id, CAST(trunc(value) AS BIGINT) AS whole FROM raw_captures WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)")
def fn06_truncated(spark: SparkSession, d: str) -> DataFrame:
    """Numbers cut to whole ones."""
    t = table(spark, d, "raw_captures").where(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf")))
    return t.select("raw_id", numbers.truncated(F.col("value")).alias("whole"))


@query("SELECT resolution, CASE resolution WHEN 'PT15M' THEN 900 WHEN 'PT0H15M' THEN 900 WHEN 'PT900S' THEN 900 WHEN 'PT30M' THEN 1800 WHEN 'PT1800S' THEN 1800 ELSE 3600 END::BIGINT AS seconds FROM (SELECT DISTINCT resolution FROM day_ahead_prices)")
def fn14_durations(spark: SparkSession, d: str) -> DataFrame:
    """Steps in seconds."""
    from almazara.functions.durations import duration_seconds

    return table(spark, d, "day_ahead_prices").select("resolution").distinct().select("resolution", duration_seconds(F.col("resolution")).alias("seconds"))


@query("SELECT event_id, ts + INTERVAL 15 MINUTE * (event_id % 96) AS instant FROM events")
def fn15_step_instant(spark: SparkSession, d: str) -> DataFrame:
    """Instant of a position on a 15-minute grid."""
    return table(spark, d, "events").select("event_id", temporal.step_instant(F.col("ts"), F.lit(900), F.col("event_id") % 96 + 1).alias("instant"))


@query("SELECT zone_key, epoch_us(timestamp_utc) AS at_us, sha256('day_ahead_prices|' || zone_key || '|' || strftime(timestamp_utc AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') || '+00:00|' || resolution || '|' || coalesce(business_type, '') || '|' || coalesce(contract_type, '') || '|' || coalesce(auction_type, '') || '|' || CASE WHEN coalesce(classification_position, 0) = 0 THEN '' ELSE CAST(classification_position AS VARCHAR) END) AS id FROM day_ahead_prices")
def fn16_record_id(spark: SparkSession, d: str) -> DataFrame:
    """Identity of a price record by hash."""
    c = F.col
    return table(spark, d, "day_ahead_prices").select("zone_key", F.unix_micros("timestamp_utc").alias("at_us"), ids.price_record_id(F.lit("day_ahead_prices"), c("zone_key"), c("timestamp_utc"), c("resolution"), c("business_type"), c("contract_type"), c("auction_type"), c("classification_position")).alias("id"))


@query("SELECT document_id, revision_number, sha256(coalesce(document_id, '') || chr(31) || coalesce(CAST(revision_number AS VARCHAR), '') || chr(31) || '0') AS id FROM (SELECT DISTINCT document_id, revision_number FROM day_ahead_prices)")
def fn17_version_id(spark: SparkSession, d: str) -> DataFrame:
    """Identity of a version by hash."""
    t = table(spark, d, "day_ahead_prices").select("document_id", "revision_number").distinct()
    return t.select("document_id", "revision_number", ids.version_id(F.col("document_id"), F.col("revision_number").cast("string"), F.lit(False)).alias("id"))


@query(r"SELECT DISTINCT regexp_extract(enlace_pdf, '([^/#?]+\.[Pp][Dd][Ff])', 1) AS pdf_name, CAST(coalesce(nullif(regexp_extract(enlace_pdf, 'page=(\d{1,9})', 1), ''), '1') AS INTEGER) AS page FROM intervenciones WHERE enlace_pdf IS NOT NULL AND regexp_extract(enlace_pdf, '([^/#?]+\.[Pp][Dd][Ff])', 1) <> ''")
def pln08_needed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages that speech links point to."""
    return planning.needed_pages(table(spark, d, "intervenciones"), "enlace_pdf")


@query("SELECT intervention_id, CAST(length(speech_text) AS INTEGER) AS chars, CASE WHEN length(objeto_iniciativa) > 30 THEN left(objeto_iniciativa, 30) || '…' ELSE objeto_iniciativa END AS shown FROM intervenciones")
def fn22_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Characters of speeches; long subjects cut with a mark."""
    return table(spark, d, "intervenciones").select("intervention_id", F.char_length("speech_text").alias("chars"), text.shortened(F.col("objeto_iniciativa"), 30).alias("shown"))


@query("SELECT intervention_id, coalesce(nullif(autor, ''), nullif(cargo_orador, ''), orador) AS speaker FROM intervenciones")
def fn26_first_truthy(spark: SparkSession, d: str) -> DataFrame:
    """First text that is not empty."""
    return table(spark, d, "intervenciones").select("intervention_id", text.first_truthy(F.col("autor"), F.col("cargo_orador"), F.col("orador")).alias("speaker"))


@query("SELECT 'coordinates' AS check_name, count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND (isnan(latitude) OR isnan(longitude) OR NOT latitude BETWEEN -90 AND 90 OR NOT longitude BETWEEN -180 AND 180)) AS failing, count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND (isnan(latitude) OR isnan(longitude) OR NOT latitude BETWEEN -90 AND 90 OR NOT longitude BETWEEN -180 AND 180)) = 0 AS passed FROM measurements UNION ALL SELECT 'before_1900', count(*) FILTER (WHERE captured_at < TIMESTAMP '1900-01-01'), count(*) FILTER (WHERE captured_at < TIMESTAMP '1900-01-01') = 0 FROM measurements UNION ALL SELECT 'after_snapshot', count(*) FILTER (WHERE captured_at > TIMESTAMP '2027-01-01'), count(*) FILTER (WHERE captured_at > TIMESTAMP '2027-01-01') = 0 FROM measurements UNION ALL SELECT 'min_rows', CAST(greatest(100 - count(*), 0) AS BIGINT), count(*) >= 100 FROM measurements")
def dq02_measurement_checks(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates, plausible times and number of rows."""
    c = F.col
    return quality.checks(table(spark, d, "measurements"), {"coordinates": quality.bad_coordinates(c("latitude"), c("longitude"), null_is_bad=False), "before_1900": c("captured_at") < F.lit("1900-01-01").cast("timestamp_ntz"), "after_snapshot": c("captured_at") > F.lit("2027-01-01").cast("timestamp_ntz")}, min_rows=100)


@query("SELECT 'unique_key' AS check_name, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS failing, coalesce(sum(n - 1), 0) = 0 AS passed FROM (SELECT count(*) AS n FROM triples GROUP BY record_id)")
def dq01_unique(spark: SparkSession, d: str) -> DataFrame:
    """Duplicate record ids."""
    return quality.unique_check(table(spark, d, "triples"), ["record_id"])


@query("SELECT object_kind_rows.collection AS collection, parts_sum, total, parts_sum = total AS passed FROM (SELECT collection, CAST(sum(n) AS BIGINT) AS parts_sum FROM (SELECT collection, object_kind, count(*) AS n FROM triples GROUP BY 1, 2) GROUP BY 1) object_kind_rows JOIN (SELECT collection, count(*) AS total FROM triples GROUP BY 1) USING (collection)")
def dq07_accounting(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of object add up to the rows of each collection."""
    t = table(spark, d, "triples")
    parts = t.groupBy("collection", "object_kind").agg(F.count("*").alias("n"))
    return quality.accounting(parts, t.groupBy("collection").agg(F.count("*").alias("all_rows")), "collection", "n", "all_rows")


@query("SELECT 2::BIGINT AS checks, CAST((CASE WHEN (SELECT count(*) - count(DISTINCT record_id) FROM triples) > 0 THEN 1 ELSE 0 END) + (CASE WHEN (SELECT count(*) FROM triples WHERE subject IS NULL) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed, CASE WHEN (SELECT count(*) - count(DISTINCT record_id) FROM triples) = 0 AND (SELECT count(*) FROM triples WHERE subject IS NULL) = 0 THEN 'pass' ELSE 'fail' END AS status")
def dq13_overall(spark: SparkSession, d: str) -> DataFrame:
    """One status of several checks."""
    t = table(spark, d, "triples")
    return quality.overall(quality.unique_check(t, ["record_id"]).unionByName(quality.required_check(t, ["subject"])))


@query("SELECT count(*) AS \"rows\", min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders")
def src23_footer_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Row count and extremes from Parquet footers alone."""
    from almazara.sources.parquet import footer_extremes

    return footer_extremes(spark, f"{d}/orders.parquet", {"key": "o_orderkey"})


@query("SELECT count(*) AS n FROM measurements WHERE captured_at < TIMESTAMP '2000-01-01'")
def src25_filtered_count(spark: SparkSession, d: str) -> DataFrame:
    """Filtered count with the predicate pushed to the scan."""
    return table(spark, d, "measurements").where(F.col("captured_at") < F.lit("2000-01-01").cast("timestamp_ntz")).agg(F.count("*").alias("n"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def str01_hourly_windows(spark: SparkSession, d: str) -> DataFrame:
    """Tumbling windows of an hour; the same plan runs on a stream (beyond the reference)."""
    from almazara.streaming.events import tumbling

    return tumbling(table(spark, d, "events"), "ts", "1 hour", ["event_type"], "value").withColumn("total", F.round("total", 4))


@query("WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, k")
def str02_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users with gaps under 30 minutes (beyond the reference)."""
    from almazara.streaming.events import sessions

    return sessions(table(spark, d, "events"), "ts", "30 minutes", ["user_id"])
