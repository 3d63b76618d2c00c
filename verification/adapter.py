"""Supplied tables -> the four raw tables, as one deterministic projection each.

``oracle.py`` holds the same mapping in SQL. All raw columns are text. Numbers go
through DECIMAL, so their text is the same in every engine. A few rules plant dirty
rows: missing regions, flags and statuses, unknown customers, dates past the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The source systems' rules in the adapter's own words: plans on sale per customer type, and
# the latency in ms and the packet loss in percent above which the agreed level is missed.
PLANS_ON_SALE = {
    "residential": ("NBN50", "NBN100", "NBN250", "NBN1000"),
    "business": ("NBN100", "NBN250", "NBN1000", "Fibre", "Business_VoIP"),
    "wholesale": ("Wholesale_Dark_Fibre", "Fibre", "NBN1000"),
}
PREMIUM = ["Business_VoIP", "Fibre", "Wholesale_Dark_Fibre"]

SHIFT_MONTHS = 300  # the supplied dates are 25 years older than the calendar


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 12, "0"))


def _flag(condition: Column) -> Column:
    return F.when(condition, "True").otherwise("False")


def _decimal(value: Column, scale: int) -> Column:
    return value.cast(f"decimal(18,{scale})").cast("string")


def _div(a: Column, b: int) -> Column:
    return F.floor(a / b)


def _month_shift(column: str, months: Column | int = SHIFT_MONTHS) -> Column:
    return F.add_months(F.col(column).cast("date"), months)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    kind = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "business")
        .when(F.col("c_mktsegment") == "BUILDING", "wholesale")
        .otherwise("residential")
    )
    plan = F.lit(None).cast("string")
    for name, plans in PLANS_ON_SALE.items():
        nth = F.get(F.array(*[F.lit(p) for p in plans]), (k % len(plans)).cast("int"))
        plan = F.when(kind == name, nth).otherwise(plan)
    # A price from the customer key; no operator depends on its level.
    price = F.when(plan.isNotNull(), F.concat((30 + k * 19 % 270).cast("string"), F.lit(".50")))
    term = _div(k, 7) % 3
    churned = (k * 11) % 20 < F.when(term == 0, 5).when(term == 1, 3).otherwise(1)
    onboarded = F.date_add(F.lit("2020-01-01").cast("date"), ((k * 13) % 1461).cast("int"))
    churn_date = F.date_add(onboarded, (30 + (k * 17) % 700).cast("int"))

    nation = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        _table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            _id("CUST-", k).alias("customer_id"),
            kind.alias("customer_type"),
            F.when(k % 97 != 0, F.col("r_name")).alias("region"),
            plan.alias("plan_type"),
            F.when(term == 0, "month-to-month").when(term == 1, "1-year").otherwise("2-year").alias("contract_type"),
            price.alias("monthly_charge_aud"),
            F.when(k % 83 == 0, "").otherwise((1 + (k * 7) % 60).cast("string")).alias("tenure_months"),
            _flag(k % 5 == 0).alias("has_cybersecurity_addon"),
            _flag(k % 4 == 0).alias("has_voip_addon"),
            onboarded.cast("string").alias("onboarded_date"),
            F.when(k % 89 == 0, "").otherwise(_flag(churned)).alias("churn_flag"),
            F.when(churned, churn_date.cast("string")).otherwise("").alias("churn_date"),
        )
    )


def network_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = customers(spark, sf_dir).select("customer_id", "region", "plan_type")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", _id("CUST-", F.col("o_custkey")).alias("customer_id"))
    lines = _table(spark, sf_dir, "lineitem")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    peak = F.col("l_quantity") * 3
    loss = F.round(F.col("l_discount") * 50, 2)
    missed = (loss > 3) | (peak > 100) | (F.col("plan_type").isin(PREMIUM) & (peak > 80))
    # Some rows belong to customers nobody knows, some lie past the end of the calendar.
    owner = F.when(order % 211 == 0, _id("LOST-", order)).otherwise(F.col("customer_id"))
    day = _month_shift("l_shipdate", F.when(order % 199 == 0, SHIFT_MONTHS + 24).otherwise(SHIFT_MONTHS))
    # Orders meet their customers first, so the wide line rows are shuffled only once.
    owned = orders.join(owners, "customer_id", "left")
    return (
        lines.join(owned, order == F.col("o_orderkey"), "left")
        .select(
            F.concat_ws("-", order.cast("string"), line.cast("string")).alias("telemetry_id"),
            owner.alias("customer_id"),
            day.cast("string").alias("date"),
            "region",
            "plan_type",
            _decimal(F.col("l_quantity") * 2, 2).alias("daily_bandwidth_gb"),
            _decimal(peak, 1).alias("peak_hour_latency_ms"),
            _decimal(F.col("l_quantity") * 1.5, 1).alias("off_peak_latency_ms"),
            _decimal(loss, 2).alias("packet_loss_percent"),
            ((line - 1) % 6).cast("string").alias("connection_drops"),
            _flag(F.coalesce(missed, F.lit(False))).alias("sla_breach"),
            _flag((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("outage_flag"),
            F.concat(F.lit("NODE-"), F.lpad((F.col("l_suppkey") % 20 + 1).cast("string"), 2, "0")).alias("node_id"),
        )
    )


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    owners = customers(spark, sf_dir).select("customer_id", "region")
    opened = F.when(e % 71 == 0, F.lit("2019-12-31").cast("date")).otherwise(F.col("ts").cast("date"))
    resolved = e % 50 < 41
    category = (
        F.when(F.col("event_type") == "click", "slow_speed")
        .when(F.col("event_type") == "view", "billing_query")
        .when(F.col("event_type") == "signup", "provisioning_delay")
        .when(F.col("event_type") == "purchase", "hardware_fault")
        .when(e % 3 == 0, "outage_report")
        .otherwise("connectivity_drop")
    )
    channel = F.get(F.array(*[F.lit(c) for c in ("phone", "email", "chat", "web_portal")]), (e % 4).cast("int"))
    owner = (
        F.when(e % 97 == 0, F.lit(None))
        .when(e % 89 == 0, _id("LOST-", e))
        .otherwise(_id("CUST-", F.col("user_id")))
    )
    return (
        _table(spark, sf_dir, "events")
        .withColumn("customer_id", owner)
        .join(owners, "customer_id", "left")
        .select(
            _id("TKT-", e).alias("ticket_id"),
            "customer_id",
            opened.cast("string").alias("open_date"),
            F.when(resolved, F.date_add(opened, (1 + e % 14).cast("int")).cast("string"))
            .otherwise("")
            .alias("close_date"),
            category.alias("issue_category"),
            "region",
            channel.alias("channel"),
            _flag(resolved).alias("resolved"),
            F.when(resolved, F.concat((1 + e % 5).cast("string"), F.lit(".0"))).otherwise("").alias("satisfaction_score"),
        )
    )


def billing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = (
        F.when(k % 101 == 0, F.lit(None))
        .when(F.col("o_orderstatus") == "O", "paid")
        .when(F.col("o_orderstatus") == "P", "late")
        .when(F.col("o_orderstatus") == "F", "failed")
    )
    month = F.trunc(_month_shift("o_orderdate"), "month")
    paid = (
        F.when(status == "paid", F.date_add(month, (1 + k % 7).cast("int")).cast("string"))
        .when(status == "late", F.date_add(month, (8 + k % 23).cast("int")).cast("string"))
        .otherwise("")
    )
    urgency = F.substring("o_orderpriority", 1, 1)
    method = (
        F.when(urgency.isin("1", "2"), "direct_debit").when(urgency == "3", "credit_card").otherwise("bank_transfer")
    )
    return _table(spark, sf_dir, "orders").select(
        k.cast("string").alias("billing_id"),
        _id("CUST-", F.col("o_custkey")).alias("customer_id"),
        month.cast("string").alias("billing_month"),
        _decimal(F.col("o_totalprice"), 2).alias("amount_charged_aud"),
        status.alias("payment_status"),
        paid.alias("payment_date"),
        method.alias("payment_method"),
    )


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, sf_dir),
        "network_telemetry": network_telemetry(spark, sf_dir),
        "support_tickets": support_tickets(spark, sf_dir),
        "billing_events": billing_events(spark, sf_dir),
    }
