"""Nested JSON sources to their relational tables: one parsed frame, one explode per child table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almazara import schemas
from almazara.functions.text import number_or_zero, strip_html, text_or_blank
from almazara.operators.relational import keep_first

# Fields of the medicine register's records.
_ITEM = "struct<id:bigint,codigo:string,nombre:string>"
_STATE = "struct<aut:bigint,susp:bigint,rev:bigint>"
MEDICINE = (
    "nregistro string, nombre string, labtitular string, labcomercializador string, cpresc string, dosis string, comerc boolean, receta boolean, generico boolean, conduc boolean, triangulo boolean, huerfano boolean, biosimilar boolean, ema boolean, psum boolean, notas boolean, materialesInf boolean, "
    f"estado {_STATE}, formaFarmaceutica {_ITEM}, formaFarmaceuticaSimplificada {_ITEM}, nosustituible {_ITEM}, vtm {_ITEM}, "
    f"presentaciones array<struct<cn:string,nombre:string,comerc:boolean,psum:boolean,estado:{_STATE}>>, "
    "principiosActivos array<struct<id:bigint,codigo:string,nombre:string,cantidad:string,unidad:string>>, "
    "excipientes array<struct<id:bigint,nombre:string,cantidad:string,unidad:string,orden:bigint>>, "
    "atcs array<struct<codigo:string,nombre:string,nivel:bigint>>, viasAdministracion array<struct<id:bigint,codigo:string,nombre:string>>, "
    "docs array<struct<tipo:bigint,url:string,urlHtml:string,fecha:bigint,secc:boolean>>, fotos array<struct<tipo:string,url:string,fecha:bigint>>"
)
CHANGE_TYPES = {1: "new", 2: "withdrawn", 3: "modified"}


def flat_item(item: str, prefix: str) -> list[Column]:
    """Id, code and name of an item; a null item gives nulls. PRJ-04."""
    return [F.col(f"{item}.id").alias(f"{prefix}_id"), F.col(f"{item}.codigo").alias(f"{prefix}_code"), F.col(f"{item}.nombre").alias(f"{prefix}_name")]


def flat_state(state: str) -> list[Column]:
    """Times of authorisation, suspension and withdrawal. PRJ-05."""
    return [F.col(f"{state}.aut").alias("authorized_at"), F.col(f"{state}.susp").alias("suspended_at"), F.col(f"{state}.rev").alias("withdrawn_at")]


def medicine_tables(records: DataFrame) -> dict[str, DataFrame]:
    """The register's main table and its child tables. NS-01, WN-04.

    ``records``: columns of ``MEDICINE``. Positions count from 0.
    """
    key = F.coalesce("nregistro", F.lit("")).alias("registration_number")
    c = F.col
    plain = {"nombre": "name", "labtitular": "holder_laboratory", "labcomercializador": "marketing_laboratory", "cpresc": "prescription_conditions", "dosis": "dose", "comerc": "marketed", "receta": "prescription_required", "generico": "generic", "conduc": "affects_driving", "triangulo": "black_triangle", "huerfano": "orphan_drug", "biosimilar": "biosimilar", "ema": "ema_authorized", "psum": "supply_problem", "notas": "has_safety_notes", "materialesInf": "has_information_materials"}
    main = records.select(key, *[c(a).alias(b) for a, b in plain.items()], *flat_state("estado"), *flat_item("formaFarmaceutica", "pharmaceutical_form"), *flat_item("formaFarmaceuticaSimplificada", "simplified_pharmaceutical_form"), *flat_item("nosustituible", "non_substitutable"), *flat_item("vtm", "virtual_therapeutic_moiety"))

    def child(array: str, fields: dict[str, str], extra: list[Column] | None = None) -> DataFrame:
        rows = records.select(key, F.posexplode(array).alias("position", "r"))
        return rows.select("registration_number", "position", *[c(f"r.{a}").alias(b) for a, b in fields.items()], *(extra or []))

    children = {
        "presentations": child("presentaciones", {"cn": "national_code", "nombre": "name", "comerc": "marketed", "psum": "supply_problem"}, flat_state("r.estado")),
        "active_ingredients": child("principiosActivos", {"id": "ingredient_id", "codigo": "ingredient_code", "nombre": "ingredient_name", "cantidad": "quantity", "unidad": "unit"}),
        "excipients": child("excipientes", {"id": "excipient_id", "nombre": "excipient_name", "cantidad": "quantity", "unidad": "unit", "orden": "source_order"}),
        "atc_codes": child("atcs", {"codigo": "atc_code", "nombre": "atc_name", "nivel": "atc_level"}),
        "administration_routes": child("viasAdministracion", {"id": "route_id", "codigo": "route_code", "nombre": "route_name"}),
        "document_links": child("docs", {"tipo": "document_type", "url": "url", "urlHtml": "html_url", "fecha": "source_updated_at", "secc": "segmented_content_available"}),
        "photos": child("fotos", {"tipo": "photo_type", "url": "url", "fecha": "source_updated_at"}),
    }
    return {name: schemas.conform(df, f"cima.{name}") for name, df in ({"medications": main} | children).items()}


def leaflet_sections(lines: DataFrame) -> DataFrame:
    """Sections of leaflets from JSON lines (column value). NS-02.

    ``sections`` is a list, or an object with the list under ``resultados`` or
    ``secciones``; a section without an order of its own has its position.
    """
    section = "array<map<string,string>>"
    listed = F.get_json_object("value", "$.sections")
    inner = F.coalesce(F.get_json_object("value", "$.sections.resultados"), F.get_json_object("value", "$.sections.secciones"))
    array = F.when(listed.startswith("["), listed).otherwise(inner)
    rows = lines.select(F.coalesce(F.get_json_object("value", "$.nregistro"), F.lit("")).alias("registration_number"), F.get_json_object("value", "$.document_type").cast("long").alias("document_type"), F.posexplode(F.from_json(array, section)).alias("position", "s"))
    s = lambda k: F.try_element_at("s", F.lit(k))
    order = F.when(F.map_contains_key("s", F.lit("orden")), s("orden").cast("long")).otherwise(F.col("position").cast("long"))
    return schemas.conform(rows.select("registration_number", "document_type", s("seccion").alias("section"), s("titulo").alias("title"), order.alias("source_order"), s("contenido").alias("content_html"), strip_html(s("contenido")).alias("content_text")), "cima.documents")


def register_changes(lines: DataFrame) -> DataFrame:
    """Changes of the register, one row per changed field, one with null where none is named. NS-03, JN-12.

    A field list given as one text is that one field.
    """
    get = lambda k: F.get_json_object("value", f"$.{k}")
    as_list = lambda t: F.when(t.startswith("["), F.from_json(t, "array<string>")).when(t.isNotNull() & (t != ""), F.array(t))
    full = lambda a: F.when(F.size(a) > 0, a)
    fields = F.coalesce(full(as_list(get("cambios"))), full(as_list(get("cambio"))), F.array(F.lit(None).cast("string")))
    rows = lines.select(F.coalesce(get("nregistro"), F.lit("")).alias("registration_number"), get("nombre").alias("medication_name"), get("labtitular").alias("holder_laboratory"), get("fecha").cast("long").alias("changed_at"), get("tipoCambio").cast("long").alias("change_type"), F.explode(fields).alias("changed_field"))
    names = F.create_map(*[F.lit(x) for k, n in CHANGE_TYPES.items() for x in (k, n)])
    return schemas.conform(rows.withColumn("change_type_name", F.coalesce(F.try_element_at(names, F.col("change_type").cast("int")), F.lit("unknown"))), "cima.changes")


def read_medicines(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of the register from JSON lines; a malformed line stops the job. SRC-11."""
    return medicine_tables(spark.read.schema(MEDICINE).json(path, mode="FAILFAST"))


def repaired_lines(lines: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(kept lines, counts) of JSON lines: malformed ones and repeats of a key after its first left out. SRC-12, WN-02.

    ``lines``: line_number, value. Counts: valid, malformed, duplicates. A line
    without the key is kept (it repeats nothing).
    """
    whole = F.col("value").rlike(r"^\s*\{")
    sound = F.when(whole, F.try_parse_json("value"))
    tagged = lines.where(F.trim("value") != "").withColumn("_ok", sound.isNotNull()).withColumn("_key", F.get_json_object("value", f"$.{key}"))
    good = tagged.where("_ok")
    kept = keep_first(good.where(F.col("_key").isNotNull()).select("_key", "line_number", "value"), ["_key"], [F.col("line_number")]).unionByName(good.where(F.col("_key").isNull()).select("_key", "line_number", "value"))
    counts = tagged.agg(F.count_if("_ok").alias("good"), F.count_if(~F.col("_ok")).alias("malformed"), (F.count_if(F.col("_ok") & F.col("_key").isNotNull()) - F.count_distinct(F.when(F.col("_ok"), F.col("_key")))).alias("duplicates"))
    return kept.select("line_number", "value"), counts.select((F.col("good") - F.col("duplicates")).alias("valid"), "malformed", "duplicates")


def product_rows(lines: DataFrame) -> DataFrame:
    """Food products of JSON lines; fields that are missing are blank, nested ones JSON. SRC-13, NS-05."""
    rows = lines.where(F.try_parse_json("value").isNotNull())
    field = lambda k: F.coalesce(F.get_json_object("value", f"$.{k}"), F.lit(""))
    names = schemas.columns("off.products")[:-2]
    return schemas.conform(rows.select(*[field(n).alias(n) for n in names], field("nutriments").alias("nutriments_json"), F.to_json(F.parse_json("value")).alias("source_json")), "off.products")


_TERM = "map<string,struct<value:string>>"


def entity_tables(lines: DataFrame) -> dict[str, DataFrame]:
    """Entities, terms, sitelinks and claims of a JSON array with one entity a line. SRC-14, NS-04, NS-05."""
    clean = F.regexp_replace(F.trim("value"), r",$", "")
    e = lines.select(clean.alias("value")).where(F.col("value").startswith("{"))
    get = lambda k: F.get_json_object("value", f"$.{k}")
    blank = lambda c: F.coalesce(c, F.lit(""))
    key = get("id").alias("entity_id")
    entities = e.select(key, blank(get("type")).alias("entity_type"), blank(get("modified")).alias("modified"), get("lastrevid").cast("long").alias("last_revision_id"))
    terms = None
    for field, kind in (("labels", "label"), ("descriptions", "description")):
        part = e.select(key, F.explode(F.from_json(get(field), _TERM)).alias("language", "t")).select("entity_id", F.lit(kind).alias("term_type"), "language", blank(F.col("t.value")).alias("value"))
        terms = part if terms is None else terms.unionByName(part)
    aliases = e.select(key, F.explode(F.from_json(get("aliases"), "map<string,array<struct<value:string>>>")).alias("language", "list")).select("entity_id", F.lit("alias").alias("term_type"), "language", F.explode("list").alias("t")).select("entity_id", "term_type", "language", blank(F.col("t.value")).alias("value"))
    links = e.select(key, F.explode(F.from_json(get("sitelinks"), "map<string,string>")).alias("site", "l"))
    links = links.select("entity_id", "site", blank(F.get_json_object("l", "$.title")).alias("title"), F.coalesce(F.get_json_object("l", "$.badges"), F.lit("[]")).alias("badges_json"))
    claims = e.select(key, F.explode(F.from_json(get("claims"), "map<string,array<string>>")).alias("property_id", "list")).select("entity_id", "property_id", F.explode("list").alias("s"))
    s = lambda k: F.get_json_object("s", f"$.{k}")
    claims = claims.select("entity_id", "property_id", blank(s("id")).alias("statement_id"), blank(s("rank")).alias("rank"), F.coalesce(s("mainsnak"), F.lit("null")).alias("mainsnak_json"), F.coalesce(s("qualifiers"), F.lit("{}")).alias("qualifiers_json"), F.coalesce(s("references"), F.lit("[]")).alias("references_json"))
    tables = {"entities": entities, "terms": terms.unionByName(aliases), "sitelinks": links, "claims": claims}
    return {n: schemas.conform(df, f"wikidata.{n}") for n, df in tables.items()}


# Fields of a ballot's file.
BALLOT = "informacion struct<sesion:int,numeroVotacion:int,fecha:string,titulo:string,textoExpediente:string,tituloSubGrupo:string,textoSubGrupo:string>, totales struct<asentimiento:string,presentes:int,afavor:int,enContra:int,abstenciones:int,noVotan:int>, votaciones array<struct<diputado:string,grupo:string,asiento:string,voto:string>>"


def ballot_tables(documents: DataFrame, legislature: int) -> dict[str, DataFrame]:
    """Ballots and the deputies' votes of JSON documents (column text); unreadable ones are left out. SRC-15, NS-12, FN-27."""
    b = documents.select(F.from_json("text", BALLOT).alias("b")).where(F.col("b.informacion").isNotNull() | F.col("b.totales").isNotNull()).select("b.*")
    i, t = (lambda k: F.col(f"informacion.{k}")), (lambda k: F.col(f"totales.{k}"))
    head = [F.lit(legislature).cast("smallint").alias("legislature"), number_or_zero(i("sesion")).alias("session_number"), number_or_zero(i("numeroVotacion")).alias("vote_number"), text_or_blank(i("fecha")).alias("date"), text_or_blank(i("titulo")).alias("title")]
    ballots = b.select(*head, text_or_blank(i("textoExpediente")).alias("expediente"), text_or_blank(i("tituloSubGrupo")).alias("subgroup_title"), text_or_blank(i("textoSubGrupo")).alias("subgroup_text"), F.coalesce(F.nullif(t("asentimiento"), F.lit("")), F.lit("No")).alias("asentimiento"), *[number_or_zero(t(a)).alias(n) for a, n in (("presentes", "presentes"), ("afavor", "afavor"), ("enContra", "en_contra"), ("abstenciones", "abstenciones"), ("noVotan", "no_votan"))])
    votes = b.select(*head, F.explode("votaciones").alias("v")).select("legislature", "session_number", "vote_number", "date", "title", *[text_or_blank(F.col(f"v.{a}")).alias(n) for a, n in (("diputado", "deputy_name"), ("grupo", "parliamentary_group"), ("asiento", "seat"), ("voto", "vote"))])
    return {"initiatives": schemas.conform(ballots, "congreso.initiatives"), "deputy_votes": schemas.conform(votes, "congreso.deputy_votes")}


def speeches_with_text(catalogue: DataFrame, pages: DataFrame) -> DataFrame:
    """Interventions with the text of the page their link points to, blank where there is none. SRC-16, JN-07, FN-22."""
    name = F.regexp_extract("enlace_pdf", r"([^/#?]+\.[Pp][Dd][Ff])", 1)
    page = F.coalesce(F.nullif(F.regexp_extract("enlace_pdf", r"page=(\d{1,9})", 1), F.lit("")).cast("int"), F.lit(1))
    p = pages.select(F.col("pdf_name").alias("_pdf"), F.col("page").alias("_page"), F.col("text").alias("_text"))
    rows = catalogue.drop("speech_text", "speech_char_count").withColumn("_name", name).withColumn("_at", page)
    rows = rows.join(p, (F.col("_name") == F.col("_pdf")) & (F.col("_at") == F.col("_page")), "left")
    return schemas.conform(rows.withColumn("speech_text", F.coalesce("_text", F.lit(""))).withColumn("speech_char_count", F.char_length("speech_text")), "congreso.intervenciones")
