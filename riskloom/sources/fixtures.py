"""Borrower-shaped inputs derived from the driver tables.

``panel``  one row per customer with six yearly statements (card-statement shape)
``scored`` panel plus a deterministic PD
``li_risk`` lineitem as a volume fixture (y = returned)
``docs_q`` documents left join labels (missing targets, string categories)
``events_period`` events with a weekly period
``vec`` first eight embedding elements as columns
``borrowers`` / ``applications`` the other two dataset shapes, derived from panel

All of them are lazy DataFrames; every aggregation pre-aggregates
map-side before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.exprs import md5_key, safe_div
from riskloom.sources.tables import read_table

N_MONTHS = 6
PANEL_LAST_YEAR = 2001
PANEL_BILL = [f"bill_amt{k}" for k in range(1, 7)]
PANEL_PAYAMT = [f"pay_amt{k}" for k in range(1, 7)]
PANEL_PAY = [f"pay_{k}" for k in range(1, 7)]
LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_year"]
PSI_CUTOFF = "1998-07-01"


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers x six yearly statements; y = has an open order in the last year."""
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey"),
        F.year("o_orderdate").alias("yr"),
        F.col("o_totalprice").alias("amt"),
        F.col("o_orderstatus").alias("st"),
    )
    aggs = []
    for k in range(1, N_MONTHS + 1):
        yr = PANEL_LAST_YEAR - k
        in_yr = F.col("yr") == yr
        aggs += [
            F.sum(F.when(in_yr, F.col("amt"))).alias(f"_bill{k}"),
            F.sum(F.when(in_yr & (F.col("st") == "F"), F.col("amt")).when(in_yr, F.lit(0.0))).alias(f"_paid{k}"),
            F.count(F.when(in_yr, 1)).alias(f"_n{k}"),
            F.count(F.when(in_yr & (F.col("st") == "O"), 1)).alias(f"_late{k}"),
        ]
    aggs.append(
        F.max(F.when((F.col("yr") == PANEL_LAST_YEAR) & (F.col("st") == "O"), 1).otherwise(0)).alias("_y")
    )
    # one shuffle on the customer key, partial aggregation map-side
    per_cust = o.groupBy("o_custkey").agg(*aggs)
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    j = cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
    cols = [
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("seg"),
        F.col("c_nationkey").alias("nationkey"),
        (F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 50).alias("limit_bal"),
    ]
    for k in range(1, N_MONTHS + 1):
        cols += [
            F.coalesce(F.col(f"_bill{k}"), F.lit(0.0)).alias(f"bill_amt{k}"),
            F.coalesce(F.col(f"_paid{k}"), F.lit(0.0)).alias(f"pay_amt{k}"),
            F.when(F.coalesce(F.col(f"_n{k}"), F.lit(0)) > 0, F.col(f"_late{k}"))
            .otherwise(F.lit(-2))
            .cast("int")
            .alias(f"pay_{k}"),
        ]
    cols.append(F.coalesce(F.col("_y"), F.lit(0)).cast("int").alias("y"))
    return j.select(*cols)


def pd_expr() -> "F.Column":
    """Deterministic PD of the ``scored`` fixture (rounded so ties agree)."""
    util1 = F.least(
        F.greatest(F.coalesce(safe_div("bill_amt1", "limit_bal"), F.lit(0.0)), F.lit(0.0)), F.lit(2.0)
    )
    z = (
        F.lit(-1.6)
        + 0.25 * F.greatest(F.col("pay_3"), F.lit(0))
        + 0.35 * F.greatest(F.col("pay_1"), F.lit(0))
        + 0.15 * F.greatest(F.col("pay_5"), F.lit(0))
        + 0.4 * util1
        - 0.00002 * F.col("limit_bal") / 10
    )
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).withColumn("pd_score", pd_expr())


def li_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a wide borrower-like table; ``part`` = expected/actual half."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        md5_key("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("key"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        F.year("l_shipdate").cast("double").alias("ship_year"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.when(F.col("l_shipdate") < F.lit(PSI_CUTOFF).cast("timestamp_ntz"), "expected")
        .otherwise("actual")
        .alias("part"),
    )


def docs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    lb = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lb, "doc_id", "left")


def events_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.date_trunc("week", "ts").alias("period"),
        F.col("value").alias("score"),
        (F.col("event_type") == "error").cast("int").alias("y"),
        "user_id",
        "event_type",
    )


def vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"v{i}") for i in range(8)]
    )


def borrowers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The borrower-table shape (delinquency counts, income, debt, dependents) from panel."""
    p = panel(spark, sf_dir)
    late = [F.greatest(F.col(f"pay_{k}"), F.lit(0)) for k in range(1, 7)]
    income = F.col("limit_bal") / 10
    return p.select(
        F.col("id").alias("ID"),
        F.least(
            F.coalesce(safe_div("bill_amt1", "limit_bal"), F.lit(0.0)), F.lit(3.0)
        ).alias("RevolvingUtilizationOfUnsecuredLines"),
        (F.lit(20) + F.col("id") % 60).cast("int").alias("age"),
        (late[2] + late[3]).cast("int").alias("NumberOfTime30-59DaysPastDueNotWorse"),
        late[1].cast("int").alias("NumberOfTime60-89DaysPastDueNotWorse"),
        late[0].cast("int").alias("NumberOfTimes90DaysLate"),
        (F.col("bill_amt1") / (income + 1)).alias("DebtRatio"),
        F.when(F.col("id") % 7 != 0, income).alias("MonthlyIncome"),
        (F.col("pay_1") + 2 + F.col("id") % 5).cast("int").alias("NumberOfOpenCreditLinesAndLoans"),
        (F.col("id") % 3).cast("int").alias("NumberRealEstateLoansOrLines"),
        F.when(F.col("id") % 17 != 0, (F.col("id") % 4).cast("double")).alias("NumberOfDependents"),
        F.col("y").alias("SeriousDlqin2yrs"),
    )


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan-application shape (amounts, day counts, external scores) from panel."""
    p = panel(spark, sf_dir)
    i = F.col("id")
    ext = {
        j: F.when(i % 13 != j, ((i * j) % 97) / 97.0).alias(f"EXT_SOURCE_{j}") for j in (1, 2, 3)
    }
    return p.select(
        i.alias("SK_ID_CURR"),
        F.col("y").alias("TARGET"),
        (F.col("limit_bal") / 10 + 1000).alias("AMT_INCOME_TOTAL"),
        (F.col("bill_amt1") + 500).alias("AMT_CREDIT"),
        (F.col("pay_amt1") / 12 + 10).alias("AMT_ANNUITY"),
        F.when(i % 5 != 0, F.col("bill_amt1") * 0.9 + 400).alias("AMT_GOODS_PRICE"),
        (-(F.lit(7300) + i % 15000)).cast("int").alias("DAYS_BIRTH"),
        F.when(i % 11 == 0, F.lit(365243)).otherwise(-(i % 4000)).cast("int").alias("DAYS_EMPLOYED"),
        (-(i % 9000)).cast("int").alias("DAYS_REGISTRATION"),
        (-(i % 5000)).cast("int").alias("DAYS_ID_PUBLISH"),
        ((i % 4) + 1).cast("double").alias("CNT_FAM_MEMBERS"),
        ext[1],
        ext[2],
        ext[3],
        (i % 3).cast("double").alias("AMT_REQ_CREDIT_BUREAU_MON"),
        (i % 5).cast("double").alias("AMT_REQ_CREDIT_BUREAU_QRT"),
        (i % 7).cast("double").alias("AMT_REQ_CREDIT_BUREAU_YEAR"),
        F.col("seg").alias("NAME_CONTRACT_TYPE"),
        F.when(i % 2 == 0, "M").otherwise("F").alias("CODE_GENDER"),
    )


def uci_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The card-statement table as one distribution ships it: generic names
    X1..X23 / Y, a leading unnamed index column, undocumented codes, text target."""
    p = panel(spark, sf_dir)
    i = F.col("id")
    cols = [
        i.alias("Unnamed: 0"),
        F.col("limit_bal").alias("X1"),
        (1 + i % 2).cast("int").alias("X2"),
        (i % 7).cast("int").alias("X3"),
        (i % 4).cast("int").alias("X4"),
        (21 + i % 50).cast("int").alias("X5"),
    ]
    cols += [F.col(f"pay_{k}").alias(f"X{5 + k}") for k in range(1, 7)]
    cols += [F.col(f"bill_amt{k}").alias(f"X{11 + k}") for k in range(1, 7)]
    cols += [F.col(f"pay_amt{k}").alias(f"X{17 + k}") for k in range(1, 7)]
    cols.append(F.col("y").cast("string").alias("Y"))
    return p.select(*cols)
