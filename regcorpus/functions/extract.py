"""Identifier, date and number extraction.

All functions return Spark ``Column`` expressions: they run inside whole-stage
codegen, no Python per row.  ``regexp_extract`` yields ``""`` when nothing
matches; the reference yields "absent", so results go through ``nullif``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference for identical results) ---------
# X1 court signature, as written in the reference (misses mixed-case WSA
# divisions such as "SA/Wa"), and the corrected default.
SIGNATURE_COMPAT = r"[IVX]+\s+[A-Z]+(?:/[A-Z]+)?\s+\d+/\d+"
SIGNATURE_FIXED = r"[IVX]+\s+[A-Z]+(?:/[A-Z][A-Za-z]*)?\s+\d+/\d+"
# CJEU case number and ECLI
CASE_NUMBER = r"[CT]-\d+/\d+"
ECLI = r"ECLI:EU:[CTF]:\d{4}:\d+"
# First date literal, national portal and CJEU portal
DATE_NATIONAL = r"\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}"
DATE_CJEU = r"\d{2}/\d{2}/\d{4}|\d{4}-\d{2}-\d{2}"
# Hosts prefixed to relative links
NATIONAL_HOST = "https://orzeczenia.nsa.gov.pl"
CJEU_HOST = "https://curia.europa.eu"
# CELEX number of a court judgment
CELEX_JUDGMENT = r"^6(\d{4})(CJ|CO|CC|CT)(\d+)$"
# Source url template of a judgment
JUDGMENT_URL = "https://eur-lex.europa.eu/legal-content/{language}/TXT/HTML/?uri=CELEX:{celex}"
# Month names (English, Polish genitive with ASCII or diacritic spelling)
MONTHS_EN = ["January", "February", "March", "April", "May", "June", "July",
             "August", "September", "October", "November", "December"]
MONTHS_PL = {"stycznia": "01", "lutego": "02", "marca": "03", "kwietnia": "04",
             "maja": "05", "czerwca": "06", "lipca": "07", "sierpnia": "08",
             "września": "09", "wrzesnia": "09", "października": "10",
             "pazdziernika": "10", "listopada": "11", "grudnia": "12"}
DATE_EN = r"(?U)(\d{1,2})\s+(January|February|March|April|May|June|July|August|September|October|November|December)\s+(\d{4})"
DATE_PL = (r"(?U)(\d{1,2})\s+(stycznia|lutego|marca|kwietnia|maja|czerwca|lipca|sierpnia"
           r"|wrze[sś]nia|pa[zź]dziernika|listopada|grudnia)\s+(\d{4})")
DATE_ISO = r"(\d{4})-(\d{2})-(\d{2})"
# Unit factors to mg/kg
UNIT_TO_MG_PER_KG = {"mg/kg": 1.0, "g/kg": 1000.0, "ug/kg": 0.001, "µg/kg": 0.001,
                     "μg/kg": 0.001, "mg/l": 1.0, "ug/l": 0.001, "µg/l": 0.001}
# ---------------------------------------------------------------------------


def first_match(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost match of ``pattern`` (or one group), NULL when absent."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def court_signature(text: Column, compat: bool = False) -> Column:
    """First court signature (``II GSK 1234/20``, ``IV SA/Wa 200/19``)."""
    return first_match(text, "(?U)" + (SIGNATURE_COMPAT if compat else SIGNATURE_FIXED))


def cjeu_case_number(text: Column) -> Column:
    """``C-544/10`` / ``T-456/21``."""
    return first_match(text, "(?U)" + CASE_NUMBER)


def ecli(text: Column) -> Column:
    """``ECLI:EU:C:2014:793``."""
    return first_match(text, "(?U)" + ECLI)


def date_literal_national(text: Column) -> Column:
    """X4 (national): first ``YYYY-MM-DD`` or ``DD.MM.YYYY``, verbatim."""
    return first_match(text, "(?U)" + DATE_NATIONAL)


def date_literal_cjeu(text: Column) -> Column:
    """X4 (CJEU): first ``DD/MM/YYYY`` or ``YYYY-MM-DD``, verbatim."""
    return first_match(text, "(?U)" + DATE_CJEU)


def typed_date(raw: Column, *formats: str) -> Column:
    """Typed DATE of a verbatim literal; NULL when no format parses it."""
    return F.coalesce(*[F.try_to_date(raw, f) for f in formats])


def absolutise_url(href: Column, host: str) -> Column:
    """A non-empty link not starting with ``http`` gets the host prefix."""
    return (F.when(href.isNull(), F.lit(None).cast("string"))
            .when((href != "") & ~href.startswith("http"), F.concat(F.lit(host), href))
            .otherwise(href))


def celex_judgment_parts(celex: Column) -> Column:
    """struct(year, case_number, short_year) or NULL when not a judgment."""
    ok = celex.rlike(CELEX_JUDGMENT)
    year = F.regexp_extract(celex, CELEX_JUDGMENT, 1)
    num = F.regexp_replace(F.regexp_extract(celex, CELEX_JUDGMENT, 3), r"^0+(?=\d)", "")
    return F.when(ok, F.struct(year.alias("year"), num.alias("case_number"),
                               F.substring(year, 3, 2).alias("short_year")))


def judgment_file_name(celex: Column, date: Column) -> Column:
    """``{date|unknown-date}-C-{n}-{yy}.md``, or ``unknown-{celex}.md``."""
    p = celex_judgment_parts(celex)
    case_part = F.concat(F.lit("C-"), p["case_number"], F.lit("-"), p["short_year"])
    has_date = date.isNotNull() & (date != "")
    return (F.when(p.isNull(), F.concat(F.lit("unknown-"), celex, F.lit(".md")))
            .when(has_date, F.concat(date, F.lit("-"), case_part, F.lit(".md")))
            .otherwise(F.concat(F.lit("unknown-date-"), case_part, F.lit(".md"))))


def _month_map(names: dict) -> Column:
    return F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])


def document_date(html: Column) -> Column:
    """English long date, else Polish long date, else ISO — each searched
    over the whole text (priority, not leftmost); ``YYYY-MM-DD``; NULL if none."""
    en = {m: f"{i + 1:02d}" for i, m in enumerate(MONTHS_EN)}

    def found(pattern, build):
        # one search of the text; the short match is taken apart
        return F.get(F.transform(F.array(F.regexp_extract(html, pattern, 0)), lambda m: F.when(m != "", build(m))), 0)

    def long_form(pattern, months):
        def parts(m):
            mon = F.coalesce(_month_map(months)[F.regexp_extract(m, pattern, 2)], F.lit("01"))
            return F.concat(F.regexp_extract(m, pattern, 3), F.lit("-"), mon, F.lit("-"), F.lpad(F.regexp_extract(m, pattern, 1), 2, "0"))
        return found(pattern, parts)

    iso = found(DATE_ISO, lambda m: m)
    return F.coalesce(long_form(DATE_EN, en), long_form(DATE_PL, MONTHS_PL), iso)


def judgment_front_matter(celex: Column, title: Column, date: Column,
                          language: str = "PL") -> Column:
    """YAML front matter; title/date lines only when non-empty; quotes in
    the title escaped."""
    url = JUDGMENT_URL.split("{celex}")[0].format(language=language)
    title_line = F.when(title.isNotNull() & (title != ""),
                        F.concat(F.lit('title: "'), F.replace(title, F.lit('"'), F.lit('\\"')), F.lit('"')))
    date_line = F.when(date.isNotNull() & (date != ""), F.concat(F.lit('date: "'), date, F.lit('"')))
    return F.concat_ws("\n", F.lit("---"), F.concat(F.lit('celex: "'), celex, F.lit('"')),
                       title_line, date_line,
                       F.concat(F.lit('source_url: "'), F.lit(url), celex, F.lit('"')),
                       F.lit("---"))


# --- X8: CELEX from an act citation ------------------------------------------
ACT_NUMBER = r"(\d{1,4})/(\d{1,4})"
ACT_TYPE_LETTER = {"rozporządzenie": "R", "rozporzadzenie": "R", "rozp.": "R",
                   "regulation": "R", "dyrektywa": "L", "directive": "L",
                   "decyzja": "D", "decision": "D"}


def celex_from_citation(number: Column, act_letter: Column | None = None) -> Column:
    """``1169/2011`` -> ``32011R1169``; ``2016/127`` -> ``32016R0127``.

    Old style is ``number/year``; from 2015 acts are numbered ``year/number``.
    Old style when the second part is a year up to 2014 and the first part
    is not a year of the new numbering (2015-2035).
    """
    a = F.regexp_extract(number, ACT_NUMBER, 1)
    b = F.regexp_extract(number, ACT_NUMBER, 2)
    old_style = ((F.length(b) == 4) & F.coalesce(b.try_cast("int").between(1950, 2014), F.lit(False))
                 & ~F.coalesce(a.try_cast("int").between(2015, 2035), F.lit(False)))
    year = F.when(old_style, b).otherwise(a)
    nr = F.when(old_style, a).otherwise(b)
    letter = act_letter if act_letter is not None else F.lit("R")
    ok = (a != "") & (F.length(year) == 4)
    return F.when(ok, F.concat(F.lit("3"), year, letter, F.lpad(nr, 4, "0")))


def consolidated_celex(celex: Column, consolidation_date: Column) -> Column:
    """``32011R1169`` + 2024-05-14 -> ``02011R1169-20240514``."""
    return F.concat(F.lit("0"), F.substring(celex, 2, 64), F.lit("-"),
                    F.date_format(consolidation_date, "yyyyMMdd"))


def act_url(celex: Column, language: str = "PL") -> Column:
    """Address of an act's text, consolidated or not."""
    return F.concat(F.lit(f"https://eur-lex.europa.eu/legal-content/{language}/TXT/?uri=CELEX:"), celex)


# --- X19: decimals with units ------------------------------------------------
def parse_amount(text: Column) -> Column:
    """``"3,0 mg/kg"`` -> struct(value DECIMAL(18,6), unit, value_mg_per_kg)."""
    num = F.regexp_extract(text, r"(\d+(?:[.,]\d+)?)", 1)
    unit = F.lower(F.regexp_extract(text, r"(?U)\d(?:[.,]\d+)?\s*([^\s\d]+/[^\s\d]+)", 1))
    value = F.regexp_replace(num, ",", ".").try_cast("decimal(18,6)")
    factor = _factor_map()[unit]
    return F.struct(value.alias("value"), F.nullif(unit, F.lit("")).alias("unit"),
                    (value * factor).cast("decimal(18,6)").alias("value_mg_per_kg"))


def _factor_map() -> Column:
    return F.create_map(*[x for k, v in UNIT_TO_MG_PER_KG.items()
                          for x in (F.lit(k), F.lit(v).cast("decimal(18,6)"))])


# --- X22: deadlines ----------------------------------------------------------
def deadline(delivery: Column, days: Column) -> Column:
    """Last day of a period of ``days`` counted from delivery."""
    return F.date_add(delivery, days.try_cast("int"))
