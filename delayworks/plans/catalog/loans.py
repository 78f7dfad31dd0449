"""Loan snapshots, days past due and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from delayworks.operators import loans as ln
from delayworks.operators import prep
from delayworks.plans import fixtures as fx
from delayworks.plans.oracle import sql
from delayworks.plans.registry import query

KEYS = ("loan_id", "Customer_ID", "snapshot_date", "installment_num")
KEYS_SQL = ", ".join(KEYS)


def silver(spark, d):
    return ln.loan_silver(fx.loans(spark, d))


@query("loan_types", sql("SELECT *, installment_num AS mob FROM fx_loans", "fx_loans"))
def loan_types(spark, d):
    return fx.loans(spark, d).transform(ln.loan_types)


@query("installments_missed", sql(f"SELECT {KEYS_SQL}, paid_amt, installments_missed FROM loan_missed", "loan_missed"))
def installments_missed(spark, d):
    rows = fx.loans(spark, d).transform(ln.loan_types).transform(ln.installments_missed)
    return rows.select(*KEYS, "paid_amt", "installments_missed")


@query("first_missed_date", sql(f"SELECT {KEYS_SQL}, first_missed_date FROM loan_first", "loan_first"))
def first_missed_date(spark, d):
    return silver(spark, d).select(*KEYS, "first_missed_date")


@query("days_past_due", sql(f"SELECT {KEYS_SQL}, dpd FROM loan_silver", "loan_silver"))
def days_past_due(spark, d):
    return silver(spark, d).select(*KEYS, "dpd")


@query("loan_silver", sql("SELECT * FROM loan_silver", "loan_silver"))
def loan_silver(spark, d):
    return silver(spark, d)


@query("loan_label", sql("""
    SELECT loan_id, Customer_ID, snapshot_date, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label FROM loan_silver WHERE mob = 6""", "loan_silver"))
def loan_label(spark, d):
    return ln.loan_label(silver(spark, d))


@query("closed_cohort", sql(f"""
    SELECT {KEYS_SQL}, dpd, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS dpd_flag FROM loan_silver
    WHERE loan_start_date < DATE '1999-01-01'""", "loan_silver"))
def closed_cohort(spark, d):
    return ln.closed_cohort(silver(spark, d), "1999-01-01").select(*KEYS, "dpd", "dpd_flag")


@query("bad_rate_curve", sql("""
    SELECT mob, round(avg(CASE WHEN dpd >= 30 THEN 1.0 ELSE 0.0 END), 6) AS bad_rate, count(*) AS loans
    FROM loan_silver WHERE loan_start_date < DATE '1999-01-01' GROUP BY mob ORDER BY mob""", "loan_silver"))
def bad_rate_curve(spark, d):
    curve = ln.bad_rate_curve(ln.closed_cohort(silver(spark, d), "1999-01-01"))
    return curve.withColumn("bad_rate", F.round("bad_rate", 6))


@query("coerce_numeric", sql("""
    SELECT feature_id, Customer_ID, label_snapshot_date, Occupation, Age_bin, TRY_CAST(fe_1 AS DOUBLE) AS fe_1, fe_2,
           CAST(fe_3 AS DOUBLE) AS fe_3 FROM fx_features""", "fx_features"))
def coerce_numeric(spark, d):
    return prep.coerce_numeric(fx.features(spark, d), ("feature_id", "Customer_ID", "label_snapshot_date", "Occupation", "Age_bin"))


@query("month_starts", sql("""
    SELECT CAST(unnest(generate_series(date_trunc('month', (SELECT min(snapshot_date) FROM fx_loans)),
           date_trunc('month', (SELECT max(snapshot_date) FROM fx_loans)), INTERVAL 1 MONTH)) AS DATE) AS month_start""", "fx_loans"))
def month_starts(spark, d):
    from delayworks.sources.readers import months_of
    return months_of(fx.loans(spark, d), "snapshot_date").select("month_start")
