"""Rule evaluators on literal rows, and the driver contract."""

import datetime as dt

from pyspark.sql import functions as F

from regcorpus.operators import rules as R


def test_contaminant_limit_switches_on_date(spark):
    s = spark.createDataFrame([
        ("PA", "herbal_tea", "300 ug/kg", dt.date(2023, 12, 31), 0.0),
        ("PA", "herbal_tea", "300 ug/kg", dt.date(2024, 1, 1), 0.0),
        ("Pb", "supplement", "3,2 mg/kg", dt.date(2024, 1, 1), 0.1),
        ("Hg", "supplement", "1 mg/kg", dt.date(2024, 1, 1), 0.0)],
        "substance string, matrix string, result string, sample_date date, u_rel double")
    rows = R.contaminant_verdicts(s, spark).collect()
    assert [r.exceeds for r in rows] == [False, True, True, None]
    assert rows[2].exceeds_after_uncertainty is False  # 3.2 * 0.9 = 2.88 <= 3.0


def test_pesticide_default_and_infant(spark):
    s = spark.createDataFrame([("p", "apple", 0.02, False), ("p", "pear", 0.02, False), ("p", "apple", 0.02, True)],
                              "pesticide string, commodity string, measured double, infant boolean")
    m = spark.createDataFrame([("p", "apple", 0.05)], "pesticide string, commodity string, mrl double")
    assert [r.exceeds for r in R.pesticide_verdicts(s, m).collect()] == [False, True, True]


def test_label_particulars_alcohol_rule(spark):
    df = spark.createDataFrame([(["name"], 0.5), (["name"], 5.0)], "present array<string>, abv double")
    rows = R.missing_particulars(df).collect()
    assert "alcohol" not in rows[0].missing and "alcohol" in rows[1].missing
    assert len(rows[0].missing) == 10


def test_gmo_and_font(spark):
    df = spark.createDataFrame([(1.0, True, True), (0.5, True, True), (0.5, True, False), (0.01, False, True)],
                               "s double, a boolean, adv boolean")
    got = [r.v for r in df.select(R.gmo_label(F.col("s"), F.col("a"), F.col("adv")).alias("v")).collect()]
    assert got == ["label required", "exempt", "label required", "not allowed"]
    f = spark.createDataFrame([(1.0, 50.0), (1.0, 100.0)], "x double, a double")
    assert [r.ok for r in f.select(R.font_ok(F.col("x"), F.col("a")).alias("ok")).collect()] == [True, False]


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["food_category", "n_claims"]
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 80


def test_infant_row_wins(spark):
    s = spark.createDataFrame([
        ("Pb", "supplement", "0,5 mg/kg", dt.date(2024, 1, 1), 0.0, True),
        ("Pb", "supplement", "0,5 mg/kg", dt.date(2024, 1, 1), 0.0, False),
        ("PA", "herbal_tea", "150 ug/kg", dt.date(2024, 1, 1), 0.0, True)],
        "substance string, matrix string, result string, sample_date date, u_rel double, infant boolean")
    rows = R.contaminant_verdicts(s, spark, infant_col="infant").collect()
    assert [float(r.limit_mg_per_kg) for r in rows] == [0.01, 3.0, 0.2]
    assert [r.exceeds for r in rows] == [True, False, False]


def test_gmo_expired_tolerance_is_not_applied(spark):
    assert R.GMO_THRESHOLD == 0.9
    assert [c for c, _, st in R.GMO_THRESHOLDS if st == "expired"] == ["unauthorised_positive_opinion"]
    df = spark.createDataFrame([(0.05, False, True)], "s double, a boolean, adv boolean")
    assert df.select(R.gmo_label(F.col("s"), F.col("a"), F.col("adv")).alias("v")).first().v == "not allowed"


def test_added_rule_rows(spark):
    from pyspark.sql import functions as F

    from regcorpus.operators import rules as R
    s = spark.createDataFrame([("PA", "herbal_infusion", "100 ug/kg", 0.0, d) for d in ("2023-06-01", "2024-06-01")],
                              "substance string, matrix string, result string, u_rel double, d string").withColumn("sample_date", F.to_date("d"))
    got = {r.d: (float(r.limit_mg_per_kg), r.exceeds) for r in R.contaminant_verdicts(s, spark).collect()}
    assert got == {"2023-06-01": (0.15, False), "2024-06-01": (0.075, True)}
    energy = spark.createDataFrame([("infant_formula", "energy", v) for v in (59.0, 60.0, 70.0, 71.0)], "regime string, nutrient string, value double")
    assert sorted((r.value, r.in_range) for r in R.composition_check(energy, spark).collect()) == [(59.0, False), (60.0, True), (70.0, True), (71.0, False)]
    food = spark.createDataFrame([(None, True), (None, False), ("1990-01-01", True)], "first string, listed boolean")
    st = food.select(R.novel_food_status(F.to_date("first"), F.lit(False), F.lit(0), F.col("listed")).alias("s"))
    assert [r.s for r in st.collect()] == ["not novel by the catalogue", "authorisation required", "not novel"]
