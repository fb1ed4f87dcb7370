"""Record normalisation (P1–P4, P6) and register filters.

Inputs hold an ``item`` column of ``map<string,string>`` (see
``sources.envelopes``).  Missing keys give ``""`` (``[]`` for the country
list); an explicit JSON null stays NULL.  All native expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regcorpus.functions import extract as X
from regcorpus.functions.jsonget import get_str, get_str_array
from regcorpus.functions.text import truncate

# --- fixed values: output field -> input keys tried in order ----------------
ALERT_FIELDS = [
    ("reference", ("reference",)), ("date", ("date",)), ("last_update", ("lastUpdate",)),
    ("notification_type", ("notificationType",)), ("subject", ("subject",)),
    ("product_category", ("productCategory",)), ("hazard", ("hazard",)),
    ("origin_country", ("originCountry",)), ("notification_country", ("notificationCountry",)),
]
CLAIM_FIELDS = [
    ("id", ("id",)), ("claim_wording", ("claimWording", "wording")),
    ("conditions_of_use", ("conditionsOfUse",)), ("status", ("claimStatus", "status")),
    ("food_category", ("foodCategory", "category")),
    ("nutrient_substance", ("nutrientSubstance", "substance")),
    ("regulation_reference", ("regulationReference",)), ("entry_type", ("entryType",)),
]
CATALOGUE_FIELDS = [
    ("name", ("name", "title")), ("status", ("status", "authorisationStatus")),
    ("category", ("category", "foodCategory")), ("applicant", ("applicant",)),
    ("date", ("date", "authorisationDate")), ("regulation", ("regulation", "regulationReference")),
    ("conditions", ("conditions", "conditionsOfUse")), ("specifications", ("specifications",)),
]
CLAIM_STATUS_FILTER = {"authorized": "AUTHORISED", "non-authorized": "NON_AUTHORISED", "all": None}
SNIPPET_CHARS = 500
CJEU_FULL_TEXT_CHARS = 10000
# ---------------------------------------------------------------------------


def _normalise(df: DataFrame, fields, item_col: str, keep) -> DataFrame:
    m = F.col(item_col)
    cols = [get_str(m, *keys).alias(name) for name, keys in fields]
    return df.filter(m.isNotNull()).select(*keep, *cols)


def normalise_alert(df: DataFrame, item_col: str = "item", keep=()) -> DataFrame:
    """11 snake_case fields; ``distribution_countries`` ARRAY<STRING>."""
    m = F.col(item_col)
    cols = [get_str(m, *keys).alias(name) for name, keys in ALERT_FIELDS]
    cols.insert(9, get_str_array(m, "distributionCountries").alias("distribution_countries"))
    cols.append(get_str(m, "status").alias("status"))
    return df.filter(m.isNotNull()).select(*keep, *cols)


def normalise_claim(df: DataFrame, item_col: str = "item", keep=()) -> DataFrame:
    """8 fields with wording/status/category/substance fallbacks."""
    return _normalise(df, CLAIM_FIELDS, item_col, keep)


def normalise_catalogue_entry(df: DataFrame, item_col: str = "item", keep=()) -> DataFrame:
    """8 fields with name/status/category/date/regulation/conditions fallbacks."""
    return _normalise(df, CATALOGUE_FIELDS, item_col, keep)


def filter_claim_status(df: DataFrame, status: str = "all") -> DataFrame:
    """``authorized`` / ``non-authorized`` / ``all`` (identity)."""
    wanted = CLAIM_STATUS_FILTER[status]
    return df if wanted is None else df.filter(F.col("status") == wanted)


def filter_equals_or_all(df: DataFrame, col: str, value: str | None) -> DataFrame:
    """category / type / term filter; empty or None means no filter."""
    return df if not value else df.filter(F.col(col) == value)


def filter_in_or_all(df: DataFrame, col: str, values) -> DataFrame:
    """notification types; an empty list means all."""
    return df if not values else df.filter(F.col(col).isin(list(values)))


def filter_term_or_all(df: DataFrame, cols, term: str | None) -> DataFrame:
    """free-text search term over the given fields (case-insensitive);
    empty means all."""
    if not term:
        return df
    hit = None
    for c in cols:
        h = F.lower(F.coalesce(F.col(c), F.lit(""))).contains(term.lower())
        hit = h if hit is None else (hit | h)
    return df.filter(hit)


def _hits(df: DataFrame, host: str, ids: dict, date: Column, usable, formats) -> DataFrame:
    """Usable rows as hits.  The patterns run once per text: a filter over
    computed columns would be pushed below them and search again, so they go
    through a one-entry array (``explode_outer`` takes no filter below it)."""
    text = F.col("text")
    found = F.array(F.struct(*[c.alias(name) for name, c in ids.items()], date.alias("date")))
    kept = F.explode_outer(F.filter(found, usable)).alias("f")
    rows = df.filter(F.length(text) >= 10).select("keyword", "row_no", "text", "href", kept).filter("f IS NOT NULL")
    return rows.select("keyword", F.col("row_no").alias("rank"), truncate(text, SNIPPET_CHARS).alias("text_snippet"),
                       *[F.col(f"f.{name}").alias(name) for name in ids], "f.date",
                       X.typed_date(F.col("f.date"), *formats).alias("date_parsed"), X.absolutise_url(F.col("href"), host).alias("url"))


def national_hits(df: DataFrame, compat: bool = False) -> DataFrame:
    """P6 + F6 (national portal): rows ``(keyword, row_no, text, href)`` ->
    usable hits with snippet, signature, date literal, typed date and url.

    Usable: text of at least 10 chars with a signature, a date or any link."""
    t = F.col("text")
    return _hits(df, X.NATIONAL_HOST, {"signature": X.court_signature(t, compat=compat)}, X.date_literal_national(t),
                 lambda f: f["signature"].isNotNull() | f["date"].isNotNull() | F.col("href").isNotNull(), ("yyyy-MM-dd", "dd.MM.yyyy"))


def cjeu_hits(df: DataFrame) -> DataFrame:
    """P6 + F6 (CJEU portal): case number, ECLI, date literal, url.

    Usable: text of at least 10 chars with a case number, an ECLI or a date;
    a link alone is not enough."""
    t = F.col("text")
    return _hits(df, X.CJEU_HOST, {"case_number": X.cjeu_case_number(t), "ecli": X.ecli(t)}, X.date_literal_cjeu(t),
                 lambda f: f["case_number"].isNotNull() | f["ecli"].isNotNull() | f["date"].isNotNull(), ("dd/MM/yyyy", "yyyy-MM-dd"))


# --- act records, rulings, searches ---------------------------------------------

def act_record(acts: DataFrame) -> DataFrame:
    """``(id, catalogue struct(name, title) | NULL, api_details struct)``
    -> id, name, title, journal reference, details.  An ad-hoc id (no
    catalogue entry) gets name = id and an empty title."""
    d = F.col("api_details")
    return acts.select(
        "id", F.coalesce(F.col("catalogue.name"), F.col("id")).alias("name"),
        F.coalesce(F.col("catalogue.title"), F.lit("")).alias("title"),
        F.concat(F.lit("Dz.U. "), d["year"].cast("string"), F.lit(" poz. "), d["position"].cast("string"))
        .alias("dziennik"), "api_details")


# fixed values: per-court key spellings, in priority order
RULING_IDENTIFIER_KEYS = ("sygnatura", "numer_sprawy", "numer_decyzji", "celex")
RULING_DATE_KEYS = ("data_orzeczenia", "data_decyzji", "date")
RULING_PROVISION_KEYS = ("przepisy", "podstawa_prawna")
RULING_THESIS_KEYS = ("teza", "teza_pl", "przedmiot")


def harmonise_rulings(parsed: DataFrame) -> DataFrame:
    """P5: court-specific front-matter fields -> identifier, date,
    provisions, thesis (first present spelling wins).  Inputs from several
    sources can be stacked first with ``unionByName(allowMissingColumns=True)``."""
    def first(keys):
        cols = [F.col(k) for k in keys if k in parsed.columns]
        return F.coalesce(*cols) if cols else F.lit(None)
    return parsed.withColumns({"identifier": first(RULING_IDENTIFIER_KEYS), "date": first(RULING_DATE_KEYS),
                               "provisions": first(RULING_PROVISION_KEYS), "thesis": first(RULING_THESIS_KEYS)})


def search_acts(acts: DataFrame, keyword: str, publisher: str = "WDU", limit: int = 20,
                date_col: str = "published", id_col: str = "act_id") -> DataFrame:
    """F3 + L2 + L3: title contains the keyword (case-insensitive), given
    publisher, newest first (id breaks ties), first ``limit`` — a top-k, so
    Spark keeps only ``limit`` rows per partition before the final merge."""
    return (acts.filter(F.lower(F.col("title")).contains(keyword.lower()) & (F.col("publisher") == publisher))
            .orderBy(F.col(date_col).desc(), F.col(id_col).desc()).limit(limit))


def court_of_signature(sig: Column) -> Column:
    """Court type of a national signature: ``SA/`` divisions are WSA,
    ``<roman> <X>SK`` chambers are NSA."""
    return (F.when(sig.contains("SA/"), "wsa")
            .when(sig.rlike(r"^[IVX]+\s+[A-Z]SK\s"), "nsa"))


def search_cases(hits: DataFrame, phrase: str, court: str = "all", text_col: str = "text_snippet") -> DataFrame:
    """hits whose text contains the phrase, for one court type or all."""
    out = hits.filter(F.lower(F.col(text_col)).contains(phrase.lower()))
    return out if court == "all" else out.filter(court_of_signature(F.col("signature")) == court)


def search_cjeu_cases(hits: DataFrame, phrase: str, language: str | None = None, courts: tuple = ("C", "T", "F"),
                      text_col: str = "text_snippet") -> DataFrame:
    """F4 (CJEU portal): hits whose text contains the phrase, in one language
    and of the given courts (Court, General Court, Civil Service Tribunal: the
    letter of the case number); hits without a case number have no court."""
    out = hits.filter(F.lower(F.col(text_col)).contains(phrase.lower()) & F.substring("case_number", 1, 1).isin(*courts))
    return out if language is None else out.filter(F.col("language") == language)


def expert_filter(docs: DataFrame, celex: str | None = None, content_type: int | None = None,
                  directory: str | None = None) -> DataFrame:
    """by document number, or by content type AND directory code."""
    if celex is not None:
        return docs.filter(F.col("celex") == celex)
    return docs.filter((F.col("content_type") == content_type) & (F.col("directory") == directory))


def accept_response(df: DataFrame, body_col: str, ct_col: str, url_col: str) -> DataFrame:
    """a response whose content type mentions html or text keeps its
    body; anything else, an absent type too, becomes a placeholder pointing at
    the url."""
    ct = F.coalesce(F.col(ct_col), F.lit(""))
    ok = ct.contains("html") | ct.contains("text")
    return df.withColumn("body", F.when(ok, F.col(body_col))).withColumn(
        "placeholder", F.when(~ok, F.concat(F.lit("[Dokument dostepny pod adresem: "), F.col(url_col), F.lit("]"))))


def edition_preference(variants: DataFrame, languages: list, consolidated: str = "T") -> DataFrame:
    """rank columns for the language preference list and consolidated
    (T) before announced (O) text; feed to ``flow.first_success``."""
    pos = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang"))
    return variants.withColumn("lang_rank", F.when(pos == 0, F.lit(999)).otherwise(pos).cast("int")).withColumn(
        "edition_rank", F.when(F.col("edition") == consolidated, 0).otherwise(1))
