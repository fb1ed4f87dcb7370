"""Compliance rules held as data.

Each rule is a small table of rule rows (fixed values stated by the corpus)
plus an evaluator that joins observations to it and decides with ``CASE``
expressions.  Rule tables are literal and tiny, so they are broadcast; data-
derived rule tables go through the size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regcorpus.functions import extract as X
from regcorpus.operators.joins import small_dim

# --- fixed values --------------------------------------------------------------
# Maximum levels (substance, matrix, limit, unit, valid_from, valid_to)
CONTAMINANT_LIMITS = [
    ("Pb", "supplement", "3.0", "mg/kg", None, None),
    ("Cd", "supplement", "1.0", "mg/kg", None, None),
    ("Cd", "algae", "0.50", "mg/kg", None, None),
    ("PA", "herbal_tea", "400", "ug/kg", None, "2024-01-01"),
    ("PA", "herbal_tea", "200", "ug/kg", "2024-01-01", None),
    ("PA", "botanical_supplement", "400", "ug/kg", None, "2024-01-01"),
    ("PA", "botanical_supplement", "200", "ug/kg", "2024-01-01", None),
    ("PA", "herbal_infusion", "150", "ug/kg", None, "2024-01-01"),
    ("PA", "herbal_infusion", "75", "ug/kg", "2024-01-01", None),
    ("PA", "pollen", "500", "ug/kg", None, None),
    ("AFB1", "supplement", "5.0", "ug/kg", None, None),
    ("OTA", "liquorice_ginger", "10", "ug/kg", None, None),
]
# Lower levels for food for infants and young children (substance, limit,
# unit); they win over the general row when a sample is infant food.  Cadmium
# is stated as 0.010-0.020 mg/kg; the upper bound is kept.
CONTAMINANT_INFANT_LIMITS = [
    ("Pb", "0.010", "mg/kg"), ("Cd", "0.020", "mg/kg"), ("AFM1", "0.10", "ug/kg"), ("OTA", "0.50", "ug/kg"),
]
# R2: default maximum residue level and the infant-food level (mg/kg)
DEFAULT_MRL = 0.01
INFANT_MRL = 0.01
# GMO thresholds (%) as rule rows (case, threshold, status); the 0.1 %
# tolerance for unauthorised GMOs with a positive EFSA opinion has expired and
# is kept as history only
GMO_THRESHOLDS = [("authorised_adventitious", 0.9, "active"),
                  ("unauthorised_positive_opinion", 0.1, "expired")]
GMO_THRESHOLD = next(t for c, t, st in GMO_THRESHOLDS if c == "authorised_adventitious" and st == "active")
# Nutrient claim thresholds (share of the reference value)
CLAIM_SOURCE, CLAIM_HIGH = 0.15, 0.30
# Composition ranges (regime, nutrient, min, max); NULL = open end
COMPOSITION_RANGES = [
    ("infant_formula", "protein", 0.45, 0.7), ("infant_formula", "fat", 1.1, 1.4),
    ("infant_formula", "carbohydrate", 2.2, 3.4), ("infant_formula", "energy", 60.0, 70.0),
    ("diet_replacement", "protein", 75.0, None), ("diet_replacement", "carbohydrate", 30.0, None),
    ("diet_replacement", "fibre", 10.0, 30.0),
]
# Plastic food contact materials
OVERALL_MIGRATION_LIMIT = 10.0   # mg/dm2
GENERIC_SPECIFIC_LIMIT = 60.0    # mg/kg when no specific limit is set
FUNCTIONAL_BARRIER_LIMIT = 0.01  # mg/kg for unlisted substances behind a functional barrier
# Mandatory particulars on a label; alcohol only above 1.2 % vol
MANDATORY_PARTICULARS = [
    "name", "ingredients", "allergens", "quid", "net_quantity", "date_marking",
    "storage_conditions", "operator", "origin", "instructions", "alcohol", "nutrition",
]
ALCOHOL_DECLARATION_ABOVE = 1.2
# Minimum x-height (mm); smaller packs (< 80 cm2) 0.9 mm
FONT_MIN_MM, FONT_MIN_SMALL_MM, SMALL_PACK_CM2 = 1.2, 0.9, 80.0
# Appeal routes (decision kind, remedy, next instance, days from delivery)
APPEAL_ROUTES = [
    ("PPIS", "appeal", "PWIS", 14), ("PWIS", "complaint", "WSA", 30),
    ("WSA", "cassation", "NSA", 30), ("GIS", "reconsideration", "GIS", 14),
    ("GIS_reconsidered", "complaint", "WSA", 30),
    ("order", "objection", "superior", 7),
]
# Validity periods in years
VALIDITY_YEARS = [("gmo_authorisation", 10), ("smoke_flavouring", 10), ("fcm_documents", 5),
                  ("data_protection", 5)]
# Procedure stages (procedure, stage_no, stage, months)
PROCEDURE_STAGES = [
    ("novel_food", 1, "validity check", 1), ("novel_food", 2, "EFSA opinion", 9),
    ("novel_food", 3, "authorisation", 7),
    ("gmo", 1, "EFSA opinion", 6), ("gmo", 2, "comitology", 3),
    ("traditional_food", 1, "notification", 4),
]
# Penalty caps
PENALTY_ABSOLUTE_CAP = 150000.0
PENALTY_TURNOVER_SHARE = 0.10
# ------------------------------------------------------------------------------


def _mg_per_kg(raw: Column, unit: Column) -> Column:
    factor = F.when(unit == "ug/kg", F.lit(0.001)).otherwise(F.lit(1.0)).cast("decimal(18,6)")
    return (raw.cast("decimal(18,6)") * factor).cast("decimal(18,6)")


def contaminant_verdicts(samples: DataFrame, spark: SparkSession, date_col: str = "sample_date",
                         infant_col: str | None = None) -> DataFrame:
    """R1 + R3 + X19: parse ``result`` ("3,2 mg/kg"), normalise to mg/kg, find
    the limit in force for (substance, matrix, date) — for infant food the
    infant row of the substance when there is one — and give two verdicts:
    the result as measured, and after deducting the expanded uncertainty
    ``u_rel`` (the two sources disagree on deduction)."""
    lim = small_dim(spark, CONTAMINANT_LIMITS,
                    "substance string, matrix string, limit_raw string, unit string, vf string, vt string")
    lim = lim.select("substance", "matrix",
                     (F.col("limit_raw").cast("decimal(18,6)")
                      * F.when(F.col("unit") == "ug/kg", F.lit(0.001)).otherwise(F.lit(1.0)).cast("decimal(18,6)"))
                     .cast("decimal(18,6)").alias("limit_mg_per_kg"),
                     F.to_date("vf").alias("valid_from"), F.to_date("vt").alias("valid_to"))
    amt = X.parse_amount(F.col("result"))
    s = samples.withColumn("value_mg_per_kg", amt["value_mg_per_kg"])
    cond = ((s["substance"] == lim["substance"]) & (s["matrix"] == lim["matrix"])
            & (lim["valid_from"].isNull() | (F.col(date_col) >= lim["valid_from"]))
            & (lim["valid_to"].isNull() | (F.col(date_col) < lim["valid_to"])))
    j = s.join(lim, cond, "left").drop(lim["substance"]).drop(lim["matrix"])
    if infant_col is not None:
        inf = small_dim(spark, CONTAMINANT_INFANT_LIMITS, "_sub string, raw string, unit string")
        inf = inf.select("_sub", _mg_per_kg(F.col("raw"), F.col("unit")).alias("_infant_limit"))
        j = (j.join(inf, (F.col("substance") == F.col("_sub")) & F.col(infant_col), "left")
             .withColumn("limit_mg_per_kg", F.coalesce("_infant_limit", "limit_mg_per_kg"))
             .drop("_sub", "_infant_limit"))
    v = F.col("value_mg_per_kg")
    return j.select(*s.columns, "limit_mg_per_kg",
                    (v > F.col("limit_mg_per_kg")).alias("exceeds"),
                    ((v.cast("double") * (1 - F.col("u_rel"))) > F.col("limit_mg_per_kg").cast("double"))
                    .alias("exceeds_after_uncertainty"))


def pesticide_verdicts(samples: DataFrame, mrls: DataFrame, keys=("pesticide", "commodity")) -> DataFrame:
    """R2: specific MRL when listed, else the default; infant food always the
    infant level."""
    j = samples.join(mrls, list(keys), "left")
    applicable = (F.when(F.col("infant"), F.lit(INFANT_MRL))
                  .otherwise(F.coalesce(F.col("mrl"), F.lit(DEFAULT_MRL))))
    return j.withColumn("applicable_mrl", applicable).withColumn(
        "used_default", ~F.col("infant") & F.col("mrl").isNull()).withColumn(
        "exceeds", F.col("measured") > F.col("applicable_mrl"))


def gmo_label(share_pct: Column, authorised: Column, adventitious: Column) -> Column:
    """Authorised above the threshold -> label; at or below and
    adventitious -> exempt; unauthorised -> not allowed at any level (the
    expired 0.1 % tolerance row is history and is not applied)."""
    return (F.when(~authorised, "not allowed")
            .when(share_pct > GMO_THRESHOLD, "label required")
            .when(adventitious, "exempt").otherwise("label required"))


def nutrient_claim(content: Column, reference_value: Column) -> Column:
    """R6: "high" >= 30 %, "source" >= 15 % of the reference value."""
    r = content / reference_value
    return F.when(r >= CLAIM_HIGH, "high").when(r >= CLAIM_SOURCE, "source").otherwise("not declarable")


def composition_check(obs: DataFrame, spark: SparkSession) -> DataFrame:
    """Each (regime, nutrient) value against its range; open ends NULL."""
    dim = small_dim(spark, COMPOSITION_RANGES, "regime string, nutrient string, lo double, hi double")
    j = obs.join(dim, ["regime", "nutrient"], "left")
    ok = ((F.col("lo").isNull() | (F.col("value") >= F.col("lo")))
          & (F.col("hi").isNull() | (F.col("value") <= F.col("hi"))))
    return j.withColumn("in_range", F.when(F.col("lo").isNull() & F.col("hi").isNull(), F.lit(None)).otherwise(ok))


def migration_check(tests: DataFrame, limits: DataFrame, article: str = "article",
                    barrier_col: str | None = None) -> DataFrame:
    """Overall migration within its limit and every substance within its
    specific limit — the generic limit when none is set, or the functional-
    barrier limit for an unlisted substance behind a barrier; per article
    ``bool_and``."""
    j = tests.join(limits, "substance", "left")
    fallback = F.lit(GENERIC_SPECIFIC_LIMIT)
    if barrier_col is not None:
        fallback = F.when(F.col(barrier_col), F.lit(FUNCTIONAL_BARRIER_LIMIT)).otherwise(fallback)
    ok = ((F.col("overall_mg_dm2") <= OVERALL_MIGRATION_LIMIT)
          & (F.col("specific_mg_kg") <= F.coalesce(F.col("sml"), fallback)))
    return j.groupBy(article).agg(F.bool_and(ok).alias("compliant"))


def normalise_wording(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(c), r"(?U)\s+", " "))


def claim_violations(used: DataFrame, authorised: DataFrame, wording_col: str = "wording") -> DataFrame:
    """A claim must equal an authorised wording (after case/space
    normalisation); anything else — paraphrases included — is a violation."""
    auth = authorised.select(normalise_wording(F.col(wording_col)).alias("_w")).distinct()
    return used.withColumn("_w", normalise_wording(F.col(wording_col))).join(auth, "_w", "left_anti").drop("_w")


def usable_authorisations(claims: DataFrame, status_col: str = "status", conditions_col: str = "conditions",
                          authorised: str = "AUTHORISED") -> DataFrame:
    """Register entries a claim may rely on — status authorised and
    conditions of use present."""
    return claims.filter((F.col(status_col) == authorised)
                         & (F.length(F.trim(F.coalesce(F.col(conditions_col), F.lit("")))) > 0))


def flag_claim_violations(used: DataFrame, authorised: DataFrame, wording_col: str = "wording") -> DataFrame:
    """R10 as a flag: every use with ``violation`` = its wording is not an
    authorised wording (left join on the normalised wording; authorised side
    distinct; paraphrases fail)."""
    auth = authorised.select(normalise_wording(F.col(wording_col)).alias("_w")).distinct() \
        .withColumn("_auth", F.lit(True))
    return (used.withColumn("_w", normalise_wording(F.col(wording_col))).join(auth, "_w", "left")
            .withColumn("violation", F.col("_auth").isNull()).drop("_w", "_auth"))


def missing_particulars(labels: DataFrame, present_col: str = "present", abv_col: str = "abv") -> DataFrame:
    """Required particulars absent from a label; the alcohol item is
    required only above 1.2 % vol."""
    req = F.array(*[F.lit(x) for x in MANDATORY_PARTICULARS])
    req = F.when(F.col(abv_col) > ALCOHOL_DECLARATION_ABOVE, req).otherwise(
        F.array_remove(req, "alcohol"))
    return labels.withColumn("missing", F.array_except(req, F.col(present_col)))


def font_ok(x_height_mm: Column, area_cm2: Column) -> Column:
    """Minimum x-height, smaller for packs under 80 cm2."""
    return x_height_mm >= F.when(area_cm2 < SMALL_PACK_CM2, FONT_MIN_SMALL_MM).otherwise(FONT_MIN_MM)


def appeal_deadlines(decisions: DataFrame, spark: SparkSession) -> DataFrame:
    """R17 + X22: remedy, next instance and last day to file (delivery +
    days); filings after it are overdue."""
    dim = small_dim(spark, APPEAL_ROUTES, "kind string, remedy string, next_instance string, days int")
    j = decisions.join(dim, "kind", "left")
    return j.withColumn("deadline", X.deadline(F.col("delivered"), F.col("days"))).withColumn(
        "overdue", F.col("filed") > F.col("deadline"))


def expiry(grants: DataFrame, spark: SparkSession, on: str) -> DataFrame:
    """expiry = grant date + validity years; expired on date ``on``."""
    dim = small_dim(spark, VALIDITY_YEARS, "kind string, years int")
    return grants.join(dim, "kind", "left").withColumn(
        "expires", F.add_months(F.col("granted"), F.col("years") * 12)).withColumn(
        "expired", F.col("expires") <= F.lit(on).cast("date"))


def procedure_timeline(cases: DataFrame, spark: SparkSession, on: str) -> DataFrame:
    """Expected end of each stage = start + cumulative months (window
    over the tiny stage table); stages not done by ``on`` past their end are
    overdue."""
    stages = small_dim(spark, PROCEDURE_STAGES, "procedure string, stage_no int, stage string, months int")
    w = Window.partitionBy("procedure").orderBy("stage_no").rowsBetween(Window.unboundedPreceding, 0)
    stages = F.broadcast(stages.withColumn("cum_months", F.sum("months").over(w)))
    j = cases.join(stages, "procedure")
    return j.withColumn("expected_end", F.add_months(F.col("started"), F.col("cum_months"))).withColumn(
        "overdue", (F.col("stage_no") > F.col("stages_done")) & (F.col("expected_end") < F.lit(on).cast("date")))


def penalty_cap(amount: Column, turnover: Column, regime: Column) -> Column:
    """Absolute cap or a share of turnover, by regime."""
    return F.when(regime == "turnover", F.least(amount, turnover * PENALTY_TURNOVER_SHARE)) \
        .otherwise(F.least(amount, F.lit(PENALTY_ABSOLUTE_CAP)))


def blend_verdicts(component_verdicts: DataFrame, blend: str = "blend", exceeds: str = "exceeds") -> DataFrame:
    """A blend is unlawful if any component lot exceeds its limit."""
    return component_verdicts.groupBy(blend).agg(
        F.bool_or(F.coalesce(F.col(exceeds), F.lit(False))).alias("unlawful"))


def traceability_gaps(moves: DataFrame, suppliers: DataFrame, recipients: DataFrame,
                      sup: str = "supplier", rec: str = "recipient", lot: str = "lot") -> DataFrame:
    """Movements whose supplier or recipient is unknown, or without a
    lot identifier, one row per gap; the movements flow through once."""
    s = suppliers.select(sup).distinct().withColumn("_sup", F.lit(True))
    r = recipients.select(rec).distinct().withColumn("_rec", F.lit(True))
    gaps = F.array(F.when(F.col("_sup").isNull(), "supplier"), F.when(F.col("_rec").isNull(), "recipient"),
                   F.when(F.col(lot).isNull(), "lot"))
    return (moves.join(s, sup, "left").join(r, rec, "left")
            .select(*moves.columns, F.explode(F.array_compact(gaps)).alias("gap")))


# --- fixed values (continued) ----------------------------------------------------
# Minimum shares (natural flavour of the named source; organic ingredients)
NATURAL_FLAVOUR_SHARE = 0.95
ORGANIC_SHARE = 0.95
# The four criteria of a food for special medical purposes
FSMP_CRITERIA = ["medical_supervision", "disease_specific_needs", "not_met_by_normal_diet", "sole_or_partial_feeding"]
# Label items of a food for special medical purposes (item, required only when applicable)
FSMP_LABEL_ITEMS = [
    ("medical_supervision_statement", False), ("dietary_management_statement", False),
    ("special_characteristics", False), ("target_patients", False), ("sole_or_partial_feeding", False),
    ("not_for_parenteral_use", True), ("energy_and_composition", False), ("osmolarity", True),
    ("protein_origin", True),
]
# Additives withdrawn from a date (E number, withdrawn from)
ADDITIVE_WITHDRAWALS = [("E171", "2022-08-07")]
# Significant consumption before this date means "not novel"; years of
# safe third-country use for the traditional-food route
NOVEL_FOOD_CUTOFF = "1997-05-15"
TRADITIONAL_USE_YEARS = 25
# Establishment regime by origin of the food (regime, authority, prior inspection)
ESTABLISHMENT_REGIMES = [("animal", "approval", "PLW", True), ("non_animal", "registration", "PPIS", False)]
# Product class criteria (class, criterion) and class priority
CLASS_CRITERIA = [
    ("medicine", "purpose_treatment"), ("medicine", "therapeutic_dose"), ("medicine", "presented_as_medicine"),
    ("supplement", "purpose_supplementation"), ("supplement", "physiological_dose"),
    ("supplement", "dosage_form"), ("food", "purpose_nutrition"), ("food", "ordinary_form"),
    ("fsmp", "medical_supervision"), ("fsmp", "disease_specific_needs"),
]
CLASS_PRIORITY = [("medicine", 1), ("fsmp", 2), ("supplement", 3), ("food", 4)]
# Minimum conversion periods in days (kind, days)
CONVERSION_DAYS = [("annual_crop", 730), ("perennial_crop", 1095), ("grassland", 730),
                   ("dairy_cattle", 183), ("beef_cattle", 365), ("small_ruminants", 183), ("poultry", 70)]
# Plant products may say "in conversion" after this many months
IN_CONVERSION_LABEL_MONTHS = 12
PLANT_KINDS = ["annual_crop", "perennial_crop", "grassland"]
# ------------------------------------------------------------------------------------


def dry_basis(value: Column, factor: Column) -> Column:
    """Value converted with the drying/concentration factor before it is
    compared (factor NULL = product as sold)."""
    return value * F.coalesce(factor, F.lit(1.0))


def share_checks(ingredients: DataFrame, product: str, weight: str, flags: dict) -> DataFrame:
    """Per product, share of weight carrying each flag and whether it
    reaches its threshold (``flags``: name -> (flag column, threshold))."""
    aggs = [F.sum(weight).alias("_total")]
    for name, (flag, _) in flags.items():
        aggs.append(F.sum(F.when(F.col(flag), F.col(weight)).otherwise(0)).alias(f"_{name}"))
    out = ingredients.groupBy(product).agg(*aggs)
    for name, (_, thr) in flags.items():
        out = out.withColumn(f"{name}_share", F.col(f"_{name}") / F.col("_total")).withColumn(
            f"{name}_ok", F.col(f"{name}_share") >= thr).drop(f"_{name}")
    return out.drop("_total")


def fsmp_definition(products: DataFrame, criteria_col: str = "criteria") -> DataFrame:
    """All four criteria must be met (``forall`` over the required list)."""
    req = F.array(*[F.lit(c) for c in FSMP_CRITERIA])
    return products.withColumn("is_fsmp", F.forall(req, lambda c: F.array_contains(F.col(criteria_col), c)))


def fsmp_label_missing(labels: DataFrame, present_col: str = "present", applicable_col: str = "applicable") -> DataFrame:
    """FSMP label items missing — the always-required items plus the
    conditional ones listed in ``applicable_col``."""
    always = F.array(*[F.lit(n) for n, cond in FSMP_LABEL_ITEMS if not cond])
    cond = F.array(*[F.lit(n) for n, c in FSMP_LABEL_ITEMS if c])
    required = F.concat(always, F.array_intersect(cond, F.coalesce(F.col(applicable_col), F.array().cast("array<string>"))))
    return labels.withColumn("missing", F.array_except(required, F.col(present_col)))


def additive_permission(uses: DataFrame, permissions: DataFrame, spark: SparkSession,
                        date_col: str = "used_on") -> DataFrame:
    """(E number, food category) must be listed; NULL maximum =
    quantum satis; a withdrawn additive is not permitted from its date."""
    wd = small_dim(spark, ADDITIVE_WITHDRAWALS, "e_number string, withdrawn string")
    j = (uses.join(permissions, ["e_number", "category"], "left").join(wd, "e_number", "left")
         .withColumn("withdrawn_from", F.to_date("withdrawn")).drop("withdrawn"))
    verdict = (F.when(F.col("withdrawn_from").isNotNull() & (F.col(date_col) >= F.col("withdrawn_from")), "withdrawn")
               .when(~F.col("listed"), "not permitted")
               .when(F.col("max_level").isNull(), "quantum satis")
               .when(F.col("level") > F.col("max_level"), "over maximum").otherwise("permitted"))
    return j.withColumn("listed", F.coalesce("listed", F.lit(False))).withColumn("verdict", verdict)


def novel_food_status(first_use: Column, on_union_list: Column, third_country_years: Column,
                      catalogue_not_novel: Column | None = None) -> Column:
    """Evidence ranked: use before the cut-off, the catalogue (indicative
    only, so it is named), union list, traditional third-country use, else
    authorisation required."""
    listed = F.coalesce(catalogue_not_novel, F.lit(False)) if catalogue_not_novel is not None else F.lit(False)
    return (F.when(first_use < F.lit(NOVEL_FOOD_CUTOFF).cast("date"), "not novel")
            .when(listed, "not novel by the catalogue")
            .when(on_union_list, "authorised novel food")
            .when(third_country_years >= TRADITIONAL_USE_YEARS, "traditional food notification")
            .otherwise("authorisation required"))


def fortification_violations(used: DataFrame, allowed: DataFrame, keys=("nutrient", "form")) -> DataFrame:
    """(nutrient, chemical form) pairs not on the allowed list."""
    return used.join(allowed.select(*keys).distinct(), list(keys), "left_anti")


def establishment_regime(est: DataFrame, spark: SparkSession, origin_col: str = "origin") -> DataFrame:
    """Approval (animal origin) or registration, supervising authority
    and whether an inspection precedes the start."""
    dim = small_dim(spark, ESTABLISHMENT_REGIMES, "origin string, regime string, authority string, prior_inspection boolean")
    return est.join(dim, est[origin_col] == dim["origin"], "left").drop(dim["origin"])


def product_class(features: DataFrame, spark: SparkSession, id_col: str, features_col: str = "features") -> DataFrame:
    """Criteria rows per class; the class matching most criteria wins
    (ties by class priority).  Criteria are unpivoted with ``explode`` and
    matched by an equi-join on the criterion."""
    crit = small_dim(spark, CLASS_CRITERIA, "class string, criterion string")
    prio = small_dim(spark, CLASS_PRIORITY, "class string, priority int")
    f = features.select(id_col, F.explode(features_col).alias("criterion"))
    scores = f.join(crit, "criterion").groupBy(id_col, "class").agg(F.count("*").alias("score"))
    best = scores.join(prio, "class").groupBy(id_col).agg(
        F.max(F.struct("score", (-F.col("priority")).alias("np"), "class")).alias("_b"))
    return features.join(best, id_col, "left").select(
        *features.columns, F.coalesce(F.col("_b.class"), F.lit("unclassified")).alias("product_class"),
        F.coalesce(F.col("_b.score"), F.lit(0)).alias("score"))


def conversion_complete(units: DataFrame, spark: SparkSession, on: str) -> DataFrame:
    """Conversion period complete on date ``on`` (kind-specific minimum);
    before that, a plant product may carry the "in conversion" indication
    once 12 months have passed."""
    dim = small_dim(spark, CONVERSION_DAYS, "kind string, min_days int")
    day = F.lit(on).cast("date")
    return (units.join(dim, "kind", "left")
            .withColumn("complete_on", F.date_add(F.col("conversion_start"), F.col("min_days")))
            .withColumn("complete", F.col("complete_on") <= day)
            .withColumn("in_conversion_label", ~F.col("complete") & F.col("kind").isin(PLANT_KINDS)
                        & (F.add_months(F.col("conversion_start"), IN_CONVERSION_LABEL_MONTHS) <= day)))
