"""Compliance rules evaluated over observations derived from the driver tables.

Stand-ins: each lineitem is a laboratory sample / label / migration test / lot
movement of its part (substance, matrix and result text chosen from its keys,
dates shifted into 2019-2025); each order is an administrative decision or a
procedure started on its order date.  The rule tables are the fixed values in
``regcorpus.operators.rules``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regcorpus.operators import rules as R
from regcorpus.plans.common import register, table

PAIRS = [("Pb", "supplement"), ("Cd", "supplement"), ("Cd", "algae"), ("PA", "herbal_tea"),
         ("PA", "botanical_supplement"), ("PA", "pollen"), ("AFB1", "supplement"),
         ("OTA", "liquorice_ginger"), ("Hg", "supplement")]


def standin_contaminant_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    idx = (F.col("l_partkey") % 9).cast("int")
    sub = F.get(F.array(*[F.lit(s) for s, _ in PAIRS]), idx)
    mat = F.get(F.array(*[F.lit(m) for _, m in PAIRS]), idx)
    q = F.col("l_quantity").cast("int")
    metal = F.concat((q / 10).cast("int").cast("string"), F.lit(","), (q % 10).cast("string"), F.lit(" mg/kg"))
    pa = F.concat((F.col("l_partkey") % 700).cast("string"), F.lit(" ug/kg"))
    myco = F.concat((q / 5).cast("int").cast("string"), F.lit(" ug/kg"))
    result = F.when(sub.isin("Pb", "Cd", "Hg"), metal).when(sub == "PA", pa).otherwise(myco)
    return li.select("l_orderkey", sub.alias("substance"), mat.alias("matrix"), result.alias("result"),
                     F.date_add(F.to_date("l_shipdate"), 9862).alias("sample_date"),
                     F.col("l_discount").alias("u_rel"), (F.col("l_linenumber") == 2).alias("infant"))


_CONTAM_CTE = """
WITH s0 AS (
  SELECT l_orderkey, l_discount AS u_rel, CAST(l_shipdate AS DATE) + 9862 AS sample_date,
         l_linenumber = 2 AS infant,
         CAST(l_quantity AS INTEGER) AS q, l_partkey,
         (['Pb','Cd','Cd','PA','PA','PA','AFB1','OTA','Hg'])[l_partkey % 9 + 1] AS substance,
         (['supplement','supplement','algae','herbal_tea','botanical_supplement','pollen','supplement',
           'liquorice_ginger','supplement'])[l_partkey % 9 + 1] AS matrix
  FROM lineitem),
s1 AS (
  SELECT *, CASE WHEN substance IN ('Pb', 'Cd', 'Hg')
                 THEN CAST(q // 10 AS VARCHAR) || ',' || CAST(q % 10 AS VARCHAR) || ' mg/kg'
                 WHEN substance = 'PA' THEN CAST(l_partkey % 700 AS VARCHAR) || ' ug/kg'
                 ELSE CAST(q // 5 AS VARCHAR) || ' ug/kg' END AS result
  FROM s0),
s AS (
  SELECT *, CAST(replace(regexp_extract(result, '(\\d+(?:[.,]\\d+)?)', 1), ',', '.') AS DECIMAL(18,6))
            * CASE WHEN result LIKE '%ug/kg' THEN 0.001 ELSE 1.0 END AS v
  FROM s1),
lim(substance, matrix, limit_raw, unit, vf, vt) AS (VALUES
  ('Pb', 'supplement', 3.0, 'mg/kg', NULL, NULL), ('Cd', 'supplement', 1.0, 'mg/kg', NULL, NULL),
  ('Cd', 'algae', 0.50, 'mg/kg', NULL, NULL),
  ('PA', 'herbal_tea', 400, 'ug/kg', NULL, DATE '2024-01-01'), ('PA', 'herbal_tea', 200, 'ug/kg', DATE '2024-01-01', NULL),
  ('PA', 'botanical_supplement', 400, 'ug/kg', NULL, DATE '2024-01-01'),
  ('PA', 'botanical_supplement', 200, 'ug/kg', DATE '2024-01-01', NULL),
  ('PA', 'pollen', 500, 'ug/kg', NULL, NULL), ('AFB1', 'supplement', 5.0, 'ug/kg', NULL, NULL),
  ('OTA', 'liquorice_ginger', 10, 'ug/kg', NULL, NULL)),
l AS (SELECT substance, matrix, vf, vt,
             CAST(limit_raw AS DECIMAL(18,6)) * CASE WHEN unit = 'ug/kg' THEN 0.001 ELSE 1.0 END AS lim_v FROM lim),
inf(substance, lim_raw, unit) AS (VALUES ('Pb', 0.010, 'mg/kg'), ('Cd', 0.020, 'mg/kg'),
  ('AFM1', 0.10, 'ug/kg'), ('OTA', 0.50, 'ug/kg')),
i AS (SELECT substance, CAST(lim_raw AS DECIMAL(18,6)) * CASE WHEN unit = 'ug/kg' THEN 0.001 ELSE 1.0 END AS inf_v
      FROM inf),
j0 AS (
  SELECT s.*, coalesce(CASE WHEN s.infant THEN i.inf_v END, l.lim_v) AS lim_v
  FROM s LEFT JOIN l ON s.substance = l.substance AND s.matrix = l.matrix
       AND (l.vf IS NULL OR s.sample_date >= l.vf) AND (l.vt IS NULL OR s.sample_date < l.vt)
  LEFT JOIN i ON s.substance = i.substance),
j AS (
  SELECT *, v > lim_v AS exceeds, CAST(v AS DOUBLE) * (1 - u_rel) > CAST(lim_v AS DOUBLE) AS exceeds_u FROM j0)
"""


@register("contaminant_verdicts", _CONTAM_CTE + """
SELECT substance, matrix, count(*) AS n_samples, count(*) FILTER (WHERE lim_v IS NULL) AS n_no_limit,
       count(*) FILTER (WHERE exceeds) AS n_exceeding,
       count(*) FILTER (WHERE exceeds_u) AS n_exceeding_after_uncertainty
FROM j GROUP BY substance, matrix
""", bench=True)
def contaminant_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 + R3 + X19: results parsed and normalised, dated limit lookup (the
    infant row wins for infant food), both uncertainty verdicts; counts per
    (substance, matrix)."""
    v = R.contaminant_verdicts(standin_contaminant_samples(spark, sf_dir), spark, infant_col="infant")
    return v.groupBy("substance", "matrix").agg(
        F.count("*").alias("n_samples"), F.count_if(F.col("limit_mg_per_kg").isNull()).alias("n_no_limit"),
        F.count_if("exceeds").alias("n_exceeding"),
        F.count_if("exceeds_after_uncertainty").alias("n_exceeding_after_uncertainty"))


@register("blend_dilution", _CONTAM_CTE + """
SELECT count(*) AS n_blends, count(*) FILTER (WHERE unlawful) AS n_unlawful
FROM (SELECT l_orderkey, bool_or(coalesce(exceeds, false)) AS unlawful FROM j GROUP BY l_orderkey) b
""")
def blend_dilution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blended lot (order) is unlawful if any component exceeds."""
    v = R.contaminant_verdicts(standin_contaminant_samples(spark, sf_dir), spark, infant_col="infant")
    b = R.blend_verdicts(v.withColumnRenamed("l_orderkey", "blend"))
    return b.agg(F.count("*").alias("n_blends"), F.count_if("unlawful").alias("n_unlawful"))


@register("pesticide_verdicts", """
WITH m AS (SELECT p_type AS pesticide, p_brand AS commodity, max(p_size / 1000.0) AS mrl
           FROM part WHERE p_size > 25 GROUP BY 1, 2),
s AS (SELECT p_type AS pesticide, p_brand AS commodity, l_tax / 2 AS measured,
             l_returnflag = 'A' AND l_linestatus = 'O' AS infant
      FROM lineitem JOIN part ON l_partkey = p_partkey),
j AS (SELECT s.*, CASE WHEN infant THEN 0.01 ELSE coalesce(m.mrl, 0.01) END AS applicable,
             NOT infant AND m.mrl IS NULL AS used_default
      FROM s LEFT JOIN m USING (pesticide, commodity))
SELECT commodity, count(*) AS n_samples, count(*) FILTER (WHERE used_default) AS n_default,
       count(*) FILTER (WHERE measured > applicable) AS n_exceeding
FROM j GROUP BY commodity
""")
def pesticide_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: specific MRL else the default 0.01 mg/kg; infant food always 0.01."""
    p = table(spark, sf_dir, "part")
    mrls = (p.filter(F.col("p_size") > 25)
            .groupBy(F.col("p_type").alias("pesticide"), F.col("p_brand").alias("commodity"))
            .agg(F.max(F.col("p_size") / 1000.0).alias("mrl")))
    li = table(spark, sf_dir, "lineitem")
    s = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_type").alias("pesticide"), F.col("p_brand").alias("commodity"),
        (F.col("l_tax") / 2).alias("measured"),
        ((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")).alias("infant"))
    v = R.pesticide_verdicts(s, mrls)
    return v.groupBy("commodity").agg(F.count("*").alias("n_samples"),
                                      F.count_if("used_default").alias("n_default"),
                                      F.count_if("exceeds").alias("n_exceeding"))


@register("gmo_labelling", """
SELECT CASE WHEN NOT (l_partkey % 3 <> 0) THEN 'not allowed'
            WHEN l_discount * 10 > 0.9 THEN 'label required'
            WHEN l_returnflag <> 'N' THEN 'exempt' ELSE 'label required' END AS verdict,
       count(*) AS n
FROM lineitem GROUP BY 1
""")
def gmo_labelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GMO presence (%), authorisation and adventitiousness -> verdict."""
    li = table(spark, sf_dir, "lineitem")
    v = R.gmo_label(F.col("l_discount") * 10, F.col("l_partkey") % 3 != 0, F.col("l_returnflag") != "N")
    return li.groupBy(v.alias("verdict")).agg(F.count("*").alias("n"))


@register("nutrient_claim_levels", """
SELECT CASE WHEN l_quantity / (l_partkey % 100 + 50) >= 0.30 THEN 'high'
            WHEN l_quantity / (l_partkey % 100 + 50) >= 0.15 THEN 'source' ELSE 'not declarable' END AS level,
       count(*) AS n
FROM lineitem GROUP BY 1
""")
def nutrient_claim_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content per 100 g as a share of the reference value -> claim."""
    li = table(spark, sf_dir, "lineitem")
    lvl = R.nutrient_claim(F.col("l_quantity"), (F.col("l_partkey") % 100 + 50).cast("double"))
    return li.groupBy(lvl.alias("level")).agg(F.count("*").alias("n"))


@register("composition_ranges", """
WITH o AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'diet_replacement' ELSE 'infant_formula' END AS regime,
         (['protein', 'fat', 'carbohydrate', 'fibre', 'energy'])[l_linenumber % 5 + 1] AS nutrient,
         CASE WHEN l_linenumber % 5 = 4 THEN 50 + l_quantity / 2 WHEN l_returnflag = 'R' THEN l_quantity * 2 ELSE l_tax * 40 END AS value
  FROM lineitem),
r(regime, nutrient, lo, hi) AS (VALUES ('infant_formula', 'protein', 0.45, 0.7), ('infant_formula', 'fat', 1.1, 1.4),
  ('infant_formula', 'carbohydrate', 2.2, 3.4), ('infant_formula', 'energy', 60, 70), ('diet_replacement', 'protein', 75.0, NULL),
  ('diet_replacement', 'carbohydrate', 30.0, NULL), ('diet_replacement', 'fibre', 10.0, 30.0))
SELECT regime, nutrient, count(*) AS n,
       count(*) FILTER (WHERE r.lo IS NOT NULL OR r.hi IS NOT NULL) AS n_with_range,
       count(*) FILTER (WHERE (r.lo IS NOT NULL OR r.hi IS NOT NULL)
                          AND (r.lo IS NULL OR value >= CAST(r.lo AS DOUBLE))
                          AND (r.hi IS NULL OR value <= CAST(r.hi AS DOUBLE))) AS n_in_range
FROM o LEFT JOIN r USING (regime, nutrient) GROUP BY regime, nutrient
""")
def composition_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composition values against (regime, nutrient) ranges, open ends."""
    li = table(spark, sf_dir, "lineitem")
    obs = li.select(
        F.when(F.col("l_returnflag") == "R", "diet_replacement").otherwise("infant_formula").alias("regime"),
        F.get(F.array(*[F.lit(x) for x in ("protein", "fat", "carbohydrate", "fibre", "energy")]),
              (F.col("l_linenumber") % 5).cast("int")).alias("nutrient"),
        F.when(F.col("l_linenumber") % 5 == 4, 50 + F.col("l_quantity") / 2)
        .when(F.col("l_returnflag") == "R", F.col("l_quantity") * 2).otherwise(F.col("l_tax") * 40).alias("value"))
    c = R.composition_check(obs, spark)
    return c.groupBy("regime", "nutrient").agg(
        F.count("*").alias("n"), F.count_if(F.col("in_range").isNotNull()).alias("n_with_range"),
        F.count_if(F.col("in_range")).alias("n_in_range"))


@register("migration_compliance", """
WITH lim AS (SELECT 'S' || CAST(p_partkey % 50 AS VARCHAR) AS substance, max(p_size * 2.0) AS sml
             FROM part WHERE p_partkey % 50 < 30 GROUP BY 1),
t AS (SELECT l_orderkey AS article, 'S' || CAST(l_partkey % 50 AS VARCHAR) AS substance,
             l_quantity / 4 AS overall_mg_dm2, l_extendedprice / 1000 AS specific_mg_kg,
             l_linestatus = 'F' AND l_returnflag = 'N' AS behind_barrier FROM lineitem),
a AS (SELECT article, bool_and(overall_mg_dm2 <= 10.0 AND specific_mg_kg <=
                               coalesce(sml, CASE WHEN behind_barrier THEN 0.01 ELSE 60.0 END)) AS compliant
      FROM t LEFT JOIN lim USING (substance) GROUP BY article)
SELECT count(*) AS n_articles, count(*) FILTER (WHERE compliant) AS n_compliant FROM a
""")
def migration_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overall and specific migration per article (generic limit when no
    specific limit is listed; functional-barrier limit behind a barrier)."""
    p = table(spark, sf_dir, "part")
    lim = (p.filter(F.col("p_partkey") % 50 < 30)
           .groupBy(F.concat(F.lit("S"), (F.col("p_partkey") % 50).cast("string")).alias("substance"))
           .agg(F.max(F.col("p_size") * 2.0).alias("sml")))
    li = table(spark, sf_dir, "lineitem")
    tests = li.select(F.col("l_orderkey").alias("article"),
                      F.concat(F.lit("S"), (F.col("l_partkey") % 50).cast("string")).alias("substance"),
                      (F.col("l_quantity") / 4).alias("overall_mg_dm2"),
                      (F.col("l_extendedprice") / 1000).alias("specific_mg_kg"),
                      ((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N")).alias("behind_barrier"))
    a = R.migration_check(tests, lim, barrier_col="behind_barrier")
    return a.agg(F.count("*").alias("n_articles"), F.count_if("compliant").alias("n_compliant"))


@register("claim_wording_violations", """
WITH auth AS (SELECT DISTINCT lower(regexp_replace(trim(p_name), '\\s+', ' ', 'g')) AS w FROM part
              WHERE p_size > 20 AND p_retailprice > 1000),
u AS (SELECT CASE l_linenumber % 4 WHEN 2 THEN upper(p_name) || '  '
                                   WHEN 3 THEN 'better ' || p_name ELSE p_name END AS wording
      FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT count(*) AS n_uses,
       count(*) FILTER (WHERE lower(regexp_replace(trim(wording), '\\s+', ' ', 'g')) NOT IN (SELECT w FROM auth))
         AS n_violations
FROM u
""")
def claim_wording_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Used claim wordings that are not the wording of an authorised
    register entry with conditions of use."""
    p = table(spark, sf_dir, "part")
    register_ = p.select(F.col("p_name").alias("wording"),
                         F.when(F.col("p_size") > 20, "AUTHORISED").otherwise("PENDING").alias("status"),
                         F.when(F.col("p_retailprice") > 1000, F.lit("max 1 portion a day")).otherwise("").alias("conditions"))
    auth = R.usable_authorisations(register_)
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_linenumber") % 4
    used = li.join(p, li.l_partkey == p.p_partkey).select(
        F.when(k == 2, F.concat(F.upper("p_name"), F.lit("  "))).when(k == 3, F.concat(F.lit("better "), "p_name"))
        .otherwise(F.col("p_name")).alias("wording"))
    flagged = R.flag_claim_violations(used, auth)
    return flagged.agg(F.count("*").alias("n_uses"), F.count_if("violation").alias("n_violations"))


# written out here, so that the oracle checks the library's list
_PARTICULARS = ['name', 'ingredients', 'allergens', 'quid', 'net_quantity', 'date_marking', 'storage_conditions', 'operator', 'origin',
    'instructions', 'alcohol', 'nutrition']


@register("label_missing_particulars", f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_tax * 100 AS abv, unnest(range(0, 12)) AS i FROM lineitem),
e AS (SELECT *, ({_PARTICULARS!r})[i + 1] AS name FROM l)
SELECT name AS particular, count(*) AS n_missing FROM e
WHERE (l_orderkey + i * 7 + l_linenumber) % 10 = 0 AND (name <> 'alcohol' OR abv > 1.2)
GROUP BY name
""")
def label_missing_particulars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required particulars missing per label (alcohol only above
    1.2 % vol); labels missing each particular."""
    li = table(spark, sf_dir, "lineitem")
    req = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(i).alias("i"))
                    for i, n in enumerate(_PARTICULARS)])
    present = F.transform(F.filter(req, lambda e: (F.col("l_orderkey") + e["i"] * 7 + F.col("l_linenumber")) % 10 != 0),
                          lambda e: e["n"])
    labels = li.select(present.alias("present"), (F.col("l_tax") * 100).alias("abv"))
    m = R.missing_particulars(labels)
    return m.select(F.explode("missing").alias("particular")).groupBy("particular").agg(
        F.count("*").alias("n_missing"))


@register("font_size_check", """
SELECT count(*) AS n_labels,
       count(*) FILTER (WHERE l_tax * 20 >= CASE WHEN l_quantity * 4 < 80.0 THEN 0.9 ELSE 1.2 END) AS n_ok
FROM lineitem
""")
def font_size_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-height against 1.2 mm (0.9 mm for packs under 80 cm2)."""
    li = table(spark, sf_dir, "lineitem")
    ok = R.font_ok(F.col("l_tax") * 20, F.col("l_quantity") * 4)
    return li.agg(F.count("*").alias("n_labels"), F.count_if(ok).alias("n_ok"))


_DECISION_KINDS = ["PPIS", "PWIS", "WSA", "GIS", "order", "unknown"]


@register("appeal_deadlines", f"""
WITH d AS (SELECT ({_DECISION_KINDS!r})[o_orderkey % 6 + 1] AS kind, CAST(o_orderdate AS DATE) AS delivered,
                  CAST(o_orderdate AS DATE) + CAST(o_custkey % 40 AS INTEGER) AS filed FROM orders),
r(kind, days) AS (VALUES ('PPIS', 14), ('PWIS', 30), ('WSA', 30), ('GIS', 14), ('order', 7))
SELECT kind, count(*) AS n, count(*) FILTER (WHERE filed > delivered + days) AS n_overdue
FROM d LEFT JOIN r USING (kind) GROUP BY kind
""")
def appeal_deadlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R17 + X22: deadline = delivery + days of the remedy; overdue filings."""
    o = table(spark, sf_dir, "orders")
    d = o.select(F.get(F.array(*[F.lit(k) for k in _DECISION_KINDS]), (F.col("o_orderkey") % 6).cast("int")).alias("kind"),
                 F.to_date("o_orderdate").alias("delivered"),
                 F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 40).cast("int")).alias("filed"))
    v = R.appeal_deadlines(d, spark)
    return v.groupBy("kind").agg(F.count("*").alias("n"), F.count_if("overdue").alias("n_overdue"))


@register("authorisation_expiry", """
WITH g AS (SELECT (['gmo_authorisation', 'smoke_flavouring', 'fcm_documents'])[o_orderkey % 3 + 1] AS kind,
                  CAST(o_orderdate AS DATE) AS granted FROM orders),
y(kind, years) AS (VALUES ('gmo_authorisation', 10), ('smoke_flavouring', 10), ('fcm_documents', 5))
SELECT kind, count(*) AS n,
       count(*) FILTER (WHERE granted + to_months(years * 12) <= DATE '2004-06-30') AS n_expired
FROM g JOIN y USING (kind) GROUP BY kind
""")
def authorisation_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expiry after 10 / 10 / 5 years; expired on 2004-06-30."""
    o = table(spark, sf_dir, "orders")
    g = o.select(F.get(F.array(*[F.lit(k) for k, _ in R.VALIDITY_YEARS]), (F.col("o_orderkey") % 3).cast("int"))
                 .alias("kind"), F.to_date("o_orderdate").alias("granted"))
    e = R.expiry(g, spark, "2004-06-30")
    return e.groupBy("kind").agg(F.count("*").alias("n"), F.count_if("expired").alias("n_expired"))


@register("procedure_overdue", """
WITH c AS (SELECT (['novel_food', 'gmo', 'traditional_food'])[o_orderkey % 3 + 1] AS procedure,
                  CAST(o_orderdate AS DATE) AS started, o_custkey % 4 AS stages_done FROM orders),
st(procedure, stage_no, stage, months) AS (VALUES ('novel_food', 1, 'validity check', 1),
  ('novel_food', 2, 'EFSA opinion', 9), ('novel_food', 3, 'authorisation', 7), ('gmo', 1, 'EFSA opinion', 6),
  ('gmo', 2, 'comitology', 3), ('traditional_food', 1, 'notification', 4)),
cs AS (SELECT *, sum(months) OVER (PARTITION BY procedure ORDER BY stage_no) AS cum FROM st)
SELECT procedure, stage, count(*) AS n,
       count(*) FILTER (WHERE stage_no > stages_done AND started + to_months(CAST(cum AS INTEGER)) < DATE '1998-06-01')
         AS n_overdue
FROM c JOIN cs USING (procedure) GROUP BY procedure, stage
""")
def procedure_overdue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected end of every stage; stages overdue on 1998-06-01."""
    o = table(spark, sf_dir, "orders")
    procs = F.array(*[F.lit(p) for p in ("novel_food", "gmo", "traditional_food")])
    c = o.select(F.get(procs, (F.col("o_orderkey") % 3).cast("int")).alias("procedure"),
                 F.to_date("o_orderdate").alias("started"), (F.col("o_custkey") % 4).alias("stages_done"))
    t = R.procedure_timeline(c, spark, "1998-06-01")
    return t.groupBy("procedure", "stage").agg(F.count("*").alias("n"), F.count_if("overdue").alias("n_overdue"))


@register("penalty_caps", """
WITH p AS (SELECT o_totalprice AS amount, c_acctbal * 1000 AS turnover,
                  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'turnover' ELSE 'absolute' END AS regime
           FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT regime, count(*) AS n,
       count(*) FILTER (WHERE CASE WHEN regime = 'turnover' THEN least(amount, turnover * 0.10)
                                   ELSE least(amount, 150000.0) END < amount) AS n_capped
FROM p GROUP BY regime
""")
def penalty_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Penalty capped absolutely (150 000) or at 10 % of turnover."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    p = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_totalprice").alias("amount"), (F.col("c_acctbal") * 1000).alias("turnover"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "turnover").otherwise("absolute").alias("regime"))
    capped = R.penalty_cap(F.col("amount"), F.col("turnover"), F.col("regime"))
    return p.groupBy("regime").agg(F.count("*").alias("n"), F.count_if(capped < F.col("amount")).alias("n_capped"))


@register("traceability_gaps", """
WITH m AS (SELECT l_suppkey AS supplier, o_custkey AS recipient,
                  CASE WHEN l_linenumber = 6 THEN NULL ELSE l_partkey END AS lot
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'supplier' AS gap, count(*) AS n FROM m
  WHERE supplier NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
UNION ALL
SELECT 'recipient', count(*) FROM m WHERE recipient NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > -500)
UNION ALL
SELECT 'lot', count(*) FROM m WHERE lot IS NULL
""")
def traceability_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lot movements with an unknown supplier, unknown recipient or no
    lot identifier."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    moves = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_suppkey").alias("supplier"), F.col("o_custkey").alias("recipient"),
        F.when(F.col("l_linenumber") == 6, F.lit(None)).otherwise(F.col("l_partkey")).alias("lot"))
    sup = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("supplier"))
    rec = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > -500).select(
        F.col("c_custkey").alias("recipient"))
    g = R.traceability_gaps(moves, sup, rec)
    kinds = spark.createDataFrame([("supplier",), ("recipient",), ("lot",)], "gap string")
    return kinds.join(g.groupBy("gap").agg(F.count("*").alias("n")), "gap", "left").withColumn(
        "n", F.coalesce("n", F.lit(0)))


_FSMP_ITEMS = ['medical_supervision_statement', 'dietary_management_statement', 'special_characteristics', 'target_patients',
    'sole_or_partial_feeding', 'not_for_parenteral_use', 'energy_and_composition', 'osmolarity', 'protein_origin']


@register("fsmp_label_missing_items", f"""
WITH e AS (SELECT p_partkey, p_size, p_type, unnest(range(0, 9)) AS i FROM part)
SELECT ({_FSMP_ITEMS!r})[i + 1] AS item, count(*) AS n_missing FROM e
WHERE (p_partkey + 3 * i) % 11 = 0
  AND (i NOT IN (5, 7, 8) OR (i = 5 AND p_type = 'SMALL') OR (i = 7 AND p_size % 2 = 0) OR (i = 8 AND p_size > 30))
GROUP BY 1
""")
def fsmp_label_missing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FSMP label items missing per product (conditional items only
    where they apply); products missing each item."""
    p = table(spark, sf_dir, "part")
    items = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(i).alias("i")) for i, n in enumerate(_FSMP_ITEMS)])
    present = F.transform(F.filter(items, lambda e: (F.col("p_partkey") + e["i"] * 3) % 11 != 0), lambda e: e["n"])
    applicable = F.filter(F.array(F.when(F.col("p_type") == "SMALL", F.lit("not_for_parenteral_use")),
                                  F.when(F.col("p_size") % 2 == 0, F.lit("osmolarity")),
                                  F.when(F.col("p_size") > 30, F.lit("protein_origin"))), lambda x: x.isNotNull())
    m = R.fsmp_label_missing(p.select(present.alias("present"), applicable.alias("applicable")))
    return m.select(F.explode("missing").alias("item")).groupBy("item").agg(F.count("*").alias("n_missing"))
