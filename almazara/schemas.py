"""Declared schemas of every table, and their required columns.

Fixed values: table and column names and types, in the order of the published
tables. ``!`` marks a required column; Spark drops that on reading files, so the
quality checks take it from here.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STATE = "authorized_at long, suspended_at long, withdrawn_at long"
_CODE = "{0}_id long, {0}_code string, {0}_name string"

_GEO = "feature_id! string, local_id string, namespace string, province_code! string, municipality_code! string, municipality_name! string, begin_lifespan_version timestamp, end_lifespan_version timestamp, source_crs! string, geometry binary, bbox_min_x double, bbox_min_y double, bbox_max_x double, bbox_max_y double, properties_json! string, source_archive! string, source_member! string"
_BUILDING = "condition_of_construction string, construction_begin date, construction_end date, current_use string, number_of_building_units long, number_of_dwellings long, floors_above_ground long, floors_below_ground long, official_area double, cadastral_parcel_refs array<string>, address_refs array<string>"
_MARKET = "record_id! string, timestamp_utc! timestamp, zone_key! string, zone_name! string, country_code! string, eic_code! string"
_MARKET_TAIL = "unit string, resolution string, curve_type string, business_type string, contract_type string, auction_type string, classification_position int, document_id string, revision_number int, timeseries_id string, source_file! string"

# Columns of an event record: names follow from the actor and place they describe.
_ACTOR = ("code", "name", "country_code", "known_group_code", "ethnic_code", "religion1_code", "religion2_code", "type1_code", "type2_code", "type3_code")
_PLACE = ("type tinyint", "full_name string", "country_code string", "adm1_code string", "latitude double", "longitude double", "feature_id string")
_EVENT = ", ".join(
    ["global_event_id long, event_date date, month_year int, year smallint, fraction_date double"]
    + [f"actor{i}_{part} string" for i in (1, 2) for part in _ACTOR]
    + ["is_root_event tinyint, event_code string, event_base_code string, event_root_code string, quad_class tinyint, goldstein_scale float, num_mentions int, num_sources int, num_articles int, avg_tone float"]
    + [f"{who}_geo_{part}" for who in ("actor1", "actor2", "action") for part in _PLACE]
    + ["date_added timestamp_ntz, source_url string"]
)

DDL = {
    "cima.medications": "registration_number string, name string, holder_laboratory string, marketing_laboratory string, prescription_conditions string, dose string, marketed boolean, prescription_required boolean, generic boolean, affects_driving boolean, black_triangle boolean, orphan_drug boolean, biosimilar boolean, ema_authorized boolean, supply_problem boolean, has_safety_notes boolean, has_information_materials boolean, " + _STATE + ", " + ", ".join(_CODE.format(p) for p in ("pharmaceutical_form", "simplified_pharmaceutical_form", "non_substitutable", "virtual_therapeutic_moiety")),
    "cima.presentations": "registration_number string, national_code string, name string, marketed boolean, supply_problem boolean, position long, " + _STATE,
    "cima.active_ingredients": "registration_number string, position long, ingredient_id long, ingredient_code string, ingredient_name string, quantity string, unit string",
    "cima.excipients": "registration_number string, position long, excipient_id long, excipient_name string, quantity string, unit string, source_order long",
    "cima.atc_codes": "registration_number string, position long, atc_code string, atc_name string, atc_level long",
    "cima.administration_routes": "registration_number string, position long, route_id long, route_code string, route_name string",
    "cima.documents": "registration_number string, document_type long, section string, title string, source_order long, content_html string, content_text string",
    "cima.document_links": "registration_number string, position long, document_type long, url string, html_url string, source_updated_at long, segmented_content_available boolean",
    "cima.photos": "registration_number string, position long, photo_type string, url string, source_updated_at long",
    "cima.changes": "registration_number string, medication_name string, holder_laboratory string, changed_at long, change_type long, change_type_name string, changed_field string",
    "ign.earthquakes": "event_id string, occurred_at_utc timestamp, latitude double, longitude double, depth_km double, maximum_intensity string, maximum_intensity_numeric double, magnitude double, magnitude_type_code string, location string, country_code string, country_name string, source_format string",
    "entsoe.day_ahead_prices": f"{_MARKET}, price! double, currency string, {_MARKET_TAIL}",
    "entsoe.actual_load": f"{_MARKET}, load! double, {_MARKET_TAIL}",
    "placsp.versions": "version_id! string, atom_id string, updated_at timestamp, published_at timestamp, title string, summary string, entry_url string, is_deleted! boolean, folder_id string, status_code string, project_name string, contract_type_code string, contract_subtype_code string, estimated_value double, budget_tax_exclusive double, budget_total double, currency string, procedure_code string, contracting_party_name string, contracting_party_nif string, contracting_party_platform_id string, contracting_party_type_code string, buyer_profile_url string, source_archive! string, source_member! string",
    "placsp.lots": "version_id! string, lot_id! string, name string, budget_tax_exclusive double, budget_total double, currency string",
    "placsp.cpv_codes": "version_id! string, lot_id string, cpv_code! string, cpv_name string",
    "placsp.awards": "version_id! string, result_position! int, winner_position! int, result_code string, description string, award_date date, received_tenders long, lot_id string, winner_name string, winner_nif string, award_tax_exclusive double, currency string",
    "omie.marginal_prices": "date date, year smallint, month tinyint, day tinyint, hour tinyint, price_es double, price_pt double",
    "omie.bidding_curves": "date date, year smallint, hour tinyint, country string, offer_type string, energy_mwh double, price_eur_mwh double, status string",
    "bne.triples": "record_id string, subject string, predicate string, object string, object_kind string, language string, datatype string, collection string, source_line long, snapshot_date date",
    "cadastre.parcels": f"{_GEO}, area_value double, label string, national_reference string",
    "cadastre.zonings": f"{_GEO}, estimated_accuracy double, label string, level string, level_name string, national_reference string, original_scale_denominator long",
    "cadastre.addresses": f"{_GEO}, locator_designator string, valid_from date, valid_to date",
    "cadastre.buildings": f"{_GEO}, {_BUILDING}",
    "cadastre.building_parts": f"{_GEO}, {_BUILDING}",
    "cadastre.other_constructions": f"{_GEO}, {_BUILDING}",
    "cadastre.municipalities": "municipality_code! string, municipality_name! string, province_code! string, parcels_archive_url string, addresses_archive_url string, buildings_archive_url string",
    "safecast.measurements": "captured_at timestamp_ntz, latitude double, longitude double, value double, unit string, location_name string, device_id long, md5sum string, height double, surface string, radiation string, uploaded_at timestamp_ntz, loader_id long",
    "gdelt.events": f"{_EVENT}, source_archive! string",
    "congreso.initiatives": "legislature smallint, session_number int, vote_number int, date string, title string, expediente string, subgroup_title string, subgroup_text string, asentimiento string, presentes int, afavor int, en_contra int, abstenciones int, no_votan int",
    "congreso.deputy_votes": "legislature smallint, session_number int, vote_number int, date string, title string, deputy_name string, parliamentary_group string, seat string, vote string",
    "congreso.intervenciones": "legislature string, super_tipo_iniciativa string, tipo_iniciativa string, objeto_iniciativa string, num_expediente string, autor string, sesion_date string, organo string, fase string, tipo_intervencion string, orador string, cargo_orador string, inicio_intervencion string, fin_intervencion string, speech_text string, speech_char_count int, enlace_texto_integro string, enlace_pdf string",
    "noaa.observations": "station_id string, date date, element string, value int, measurement_flag string, quality_flag string, source_flag string",
    "off.products": "code string, product_name string, generic_name string, brands string, quantity string, categories string, ingredients_text string, allergens string, labels string, countries string, packaging string, created_datetime string, last_modified_datetime string, nutriments_json string, source_json string",
    "wikidata.entities": "entity_id string, entity_type string, modified string, last_revision_id long",
    "wikidata.terms": "entity_id string, term_type string, language string, value string",
    "wikidata.sitelinks": "entity_id string, site string, title string, badges_json string",
    "wikidata.claims": "entity_id string, property_id string, statement_id string, rank string, mainsnak_json string, qualifiers_json string, references_json string",
    "osm.objects": "object_type string, object_id long, version int, visible boolean, timestamp string, changeset long, uid long, user string, longitude double, latitude double",
    "osm.tags": "object_type string, object_id long, version int, key string, value string",
    "osm.way_nodes": "way_id long, version int, position int, node_id long",
    "osm.relation_members": "relation_id long, version int, position int, member_type string, member_id long, role string",
}


def _split(ddl: str) -> list[tuple[str, bool, str]]:
    out = []
    for field in ddl.split(", "):
        name, kind = field.split(" ", 1)
        out.append((name.rstrip("!"), name.endswith("!"), kind))
    return out


def ddl(name: str) -> str:
    """Plain DDL of a table's columns."""
    return ", ".join(f"`{n}` {k}" for n, _, k in _split(DDL[name]))


def schema(name: str) -> T.StructType:
    """Declared schema of a table; needs an active session."""
    return T.StructType.fromDDL(ddl(name))


def columns(name: str) -> list[str]:
    """Column names of a table, in order."""
    return [n for n, _, _ in _split(DDL[name])]


def required(name: str) -> list[str]:
    """Columns of a table that must not be null. DQ-04."""
    return [n for n, must, _ in _split(DDL[name]) if must]


def conform(df, name: str):
    """``df`` with exactly the declared columns and types; absent columns are null. PRJ-03, PRJ-06."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(*[(F.col(f"`{n}`") if n in have else F.lit(None)).cast(k).alias(n) for n, _, k in _split(DDL[name])])


def export(name: str) -> list[dict]:
    """[{name, type, nullable}] of a table, for artifacts."""
    return [{"name": n, "type": k, "nullable": not must} for n, must, k in _split(DDL[name])]
