"""What is known of each declared table, and the analysis that follows from it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almazara import schemas
from almazara.operators import profile, quality

# Labels of the four classes of events, and the register's master lists.
QUAD_CLASSES = {1: "verbal cooperation", 2: "material cooperation", 3: "verbal conflict", 4: "material conflict"}
MASTER_LISTS = {1: "active_ingredients", 3: "pharmaceutical_forms", 4: "administration_routes", 6: "laboratories", 7: "atc_codes", 11: "active_ingredients_snomed", 13: "pharmaceutical_forms_snomed", 14: "administration_routes_snomed", 15: "medications_snomed", 16: "marketed_medications_snomed"}


@dataclass(frozen=True)
class TableFacts:
    """Keys, times, numbers, groups and places of a table."""

    keys: tuple[str, ...] = ()
    times: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    groups: tuple[str, ...] = ()
    coordinates: tuple[tuple[str, str], ...] = ()
    null_place_is_bad: bool = False
    labels: dict = field(default_factory=dict)
    never_negative: tuple[str, ...] = ()


_REGISTER = ("registration_number",)
_PLACED = ("registration_number", "position")
_FEATURE = TableFacts(keys=("feature_id",), times=("begin_lifespan_version",), numbers=("bbox_min_x", "bbox_min_y", "bbox_max_x", "bbox_max_y"), groups=("province_code",))
FACTS: dict[str, TableFacts] = {
    "cima.medications": TableFacts(keys=_REGISTER, groups=("holder_laboratory", "marketed")),
    "cima.presentations": TableFacts(keys=_PLACED, groups=("marketed",)),
    "cima.active_ingredients": TableFacts(keys=_PLACED, groups=("ingredient_name",)),
    "cima.excipients": TableFacts(keys=_PLACED, groups=("excipient_name",)),
    "cima.atc_codes": TableFacts(keys=_PLACED, groups=("atc_code",)),
    "cima.administration_routes": TableFacts(keys=_PLACED, groups=("route_name",)),
    "cima.documents": TableFacts(groups=("document_type", "section")),
    "cima.document_links": TableFacts(keys=_PLACED, groups=("document_type",)),
    "cima.photos": TableFacts(keys=_PLACED, groups=("photo_type",)),
    "cima.changes": TableFacts(groups=("change_type_name", "changed_field")),
    "ign.earthquakes": TableFacts(keys=("event_id",), times=("occurred_at_utc",), numbers=("magnitude", "depth_km"), groups=("country_code", "magnitude_type_code", "source_format"), coordinates=(("latitude", "longitude"),), null_place_is_bad=True, never_negative=("depth_km",)),
    "entsoe.day_ahead_prices": TableFacts(keys=("record_id",), times=("timestamp_utc",), numbers=("price",), groups=("zone_key", "resolution", "currency")),
    "entsoe.actual_load": TableFacts(keys=("record_id",), times=("timestamp_utc",), numbers=("load",), groups=("zone_key", "resolution"), never_negative=("load",)),
    "placsp.versions": TableFacts(keys=("version_id",), times=("updated_at",), numbers=("estimated_value",), groups=("status_code", "contract_type_code", "is_deleted")),
    "placsp.lots": TableFacts(keys=("version_id", "lot_id"), numbers=("budget_tax_exclusive",)),
    "placsp.cpv_codes": TableFacts(groups=("cpv_code",)),
    "placsp.awards": TableFacts(keys=("version_id", "result_position", "winner_position"), times=("award_date",), numbers=("award_tax_exclusive",), groups=("result_code",)),
    "omie.marginal_prices": TableFacts(keys=("date", "hour"), times=("date",), numbers=("price_es", "price_pt")),
    "omie.bidding_curves": TableFacts(times=("date",), numbers=("energy_mwh", "price_eur_mwh"), groups=("country", "offer_type", "status")),
    "bne.triples": TableFacts(keys=("record_id",), groups=("predicate", "object_kind", "language", "datatype", "collection")),
    **{f"cadastre.{t}": _FEATURE for t in ("parcels", "zonings", "addresses", "buildings", "building_parts", "other_constructions")},
    "cadastre.municipalities": TableFacts(keys=("municipality_code",), groups=("province_code",)),
    "safecast.measurements": TableFacts(times=("captured_at", "uploaded_at"), numbers=("value",), groups=("unit",), coordinates=(("latitude", "longitude"),)),
    "gdelt.events": TableFacts(keys=("global_event_id",), times=("event_date",), numbers=("goldstein_scale", "num_mentions", "avg_tone"), groups=("quad_class", "event_root_code", "actor1_country_code", "actor2_country_code", "action_geo_country_code"), coordinates=tuple((f"{w}_geo_latitude", f"{w}_geo_longitude") for w in ("actor1", "actor2", "action")), labels={"quad_class": QUAD_CLASSES}),
    "congreso.initiatives": TableFacts(keys=("legislature", "session_number", "vote_number"), numbers=("presentes",), groups=("asentimiento",)),
    "congreso.deputy_votes": TableFacts(groups=("parliamentary_group", "vote")),
    "congreso.intervenciones": TableFacts(numbers=("speech_char_count",), groups=("organo", "fase")),
    "noaa.observations": TableFacts(keys=("station_id", "date", "element"), times=("date",), numbers=("value",), groups=("element", "quality_flag")),
    "off.products": TableFacts(keys=("code",), groups=("brands", "countries")),
    "wikidata.entities": TableFacts(keys=("entity_id",), groups=("entity_type",)),
    "wikidata.terms": TableFacts(groups=("term_type", "language")),
    "wikidata.sitelinks": TableFacts(keys=("entity_id", "site"), groups=("site",)),
    "wikidata.claims": TableFacts(keys=("statement_id",), groups=("property_id", "rank")),
    "osm.objects": TableFacts(keys=("object_type", "object_id", "version"), groups=("object_type", "visible"), coordinates=(("latitude", "longitude"),)),
    "osm.tags": TableFacts(keys=("object_type", "object_id", "version", "key"), groups=("key",)),
    "osm.way_nodes": TableFacts(keys=("way_id", "version", "position")),
    "osm.relation_members": TableFacts(keys=("relation_id", "version", "position"), groups=("member_type",)),
}


def quality_report(df: DataFrame, name: str, *, min_rows: int = 1) -> DataFrame:
    """(check_name, failing, passed) of everything that is known of a table. DQ-01 to DQ-10."""
    facts = FACTS[name]
    failures = {f"{c}_not_null": F.col(c).isNull() for c in schemas.required(name)}
    failures |= {f"{a}_{b}_in_range": quality.bad_coordinates(F.col(a), F.col(b), null_is_bad=facts.null_place_is_bad) for a, b in facts.coordinates}
    failures |= {f"{c}_not_negative": F.col(c) < 0 for c in facts.never_negative}
    failures |= {f"{c}_finite": F.isnan(c) | (F.abs(c) == float("inf")) for c in facts.numbers if dict(df.dtypes)[c] in ("double", "float")}
    out = quality.checks(df, failures, min_rows=min_rows)
    return out.unionByName(quality.unique_check(df, list(facts.keys))) if facts.keys else out


def analysis(df: DataFrame, name: str, k: int = 20) -> dict[str, DataFrame]:
    """Frames of a table's analysis: coverage, numbers, extents, years, most frequent values and shares."""
    facts = FACTS[name]
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("binary", "array", "map", "struct")]
    out = {"coverage": profile.field_coverage(df, plain)}
    for c in facts.numbers:
        out[f"summary_{c}"] = profile.numeric_summary(df, c)
    if facts.times:
        out["extent"] = profile.extent(df, {c: c for c in facts.times})
        out["years"] = profile.year_histogram(df, facts.times[0])
    for c in facts.groups:
        out[f"shares_{c}" if c in facts.labels else f"top_{c}"] = profile.shares(df, c, facts.labels[c]) if c in facts.labels else profile.value_counts(df, c, k)
    return out


def master_lists(spark: SparkSession) -> DataFrame:
    """(master_id, master_name) of the register's lists. PLN-06."""
    return spark.createDataFrame(list(MASTER_LISTS.items()), "master_id int, master_name string")


def with_master_names(rows: DataFrame) -> DataFrame:
    """Rows of master lists (master_id) with their list's name; unknown lists are left out. PLN-06."""
    return rows.join(master_lists(rows.sparkSession), "master_id")


def municipality_table(tasks: DataFrame) -> DataFrame:
    """One row per municipality with the archive of each collection, from tasks municipality_code, municipality_name, province_code, collection, url. JN-11."""
    urls = [F.max(F.when(F.col("collection") == c, F.col("url"))).alias(f"{c}_archive_url") for c in ("parcels", "addresses", "buildings")]
    out = tasks.groupBy("municipality_code").agg(F.first("municipality_name").alias("municipality_name"), F.first("province_code").alias("province_code"), *urls)
    return schemas.conform(out, "cadastre.municipalities")


def checkpoint_is_whole(df: DataFrame, expected_rows: int, key: str | None = None, value=None) -> bool:
    """Whether a checkpoint holds the rows it should, all of one key. DQ-14."""
    wrong = F.count_if(~F.col(key).eqNullSafe(F.lit(value))) if key else F.lit(0)
    one = df.agg(F.count(F.lit(1)).alias("n"), wrong.alias("wrong")).first()
    return one.n == expected_rows and one.wrong == 0
