"""Masked and row-filtered views, pseudonymised exports, order risk."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scoring import amount_bucket, email_domain, fraud_score, mask_email, mask_pan
from millrace.plans.relational import since

# The two role sets differ on purpose.
CLEAR_EMAIL_ROLES = ("SECURITY_ADMIN", "PII_ADMIN")
ALL_ROWS_ROLES = ("ACCOUNTADMIN", "SECURITY_ADMIN")


def secure_customers(customers: DataFrame, role_map: DataFrame, role: str) -> DataFrame:
    """What one role may see: masked e-mail, and rows of its mapped countries."""
    rows = customers
    if role not in ALL_ROWS_ROLES:
        allowed = role_map.where(F.col("role_name") == role).select("country")
        rows = rows.join(allowed, "country", "left_semi")
    email = F.col("email") if role in CLEAR_EMAIL_ROLES else mask_email(F.col("email"))
    return rows.select(
        "customer_id", "first_name", "last_name", email.alias("email"), "country", "signup_ts", "is_active"
    )


def role_views(customers: DataFrame, role_map: DataFrame, roles: list[str]) -> DataFrame:
    views = [
        secure_customers(customers, role_map, role).select(F.lit(role).alias("role"), "customer_id", "email", "country")
        for role in roles
    ]
    return reduce(DataFrame.unionByName, views)


def pii_projection(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.base64(F.encode("email", "UTF-8")).alias("email_b64"),
        F.sha2(F.lower("email"), 256).alias("email_hash"),
    )


def order_risk(orders: DataFrame, customers: DataFrame, as_of: datetime, days: int = 1) -> DataFrame:
    recent = orders.where(F.col("order_ts") >= since(as_of, f"{days} days"))
    who = customers.select("customer_id", "email", "country")
    return recent.join(who, "customer_id").select(
        "order_id",
        email_domain(F.col("email")).alias("email_domain"),
        amount_bucket(F.col("total_amount")).alias("amt_bucket"),
        mask_pan(F.col("card_pan")).alias("masked_pan"),
        fraud_score(F.col("total_amount"), F.col("channel"), F.col("country")).alias("fraud_score"),
    )


def customer_audit_log(customers: DataFrame, as_of: datetime) -> DataFrame:
    """One audit row per active customer, as one append instead of a loop."""
    stamp = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return customers.where("is_active").select("customer_id", stamp.alias("audited_at"))


def append_audit_log(customers: DataFrame, path: str, as_of: datetime) -> DataFrame:
    """Append the audit rows of a run to the log at ``path``, which is returned.

    A run's rows are a partition of their own, so a run that is repeated replaces its rows.
    """
    rows = customer_audit_log(customers, as_of)
    tagged = rows.withColumn("run", F.date_format("audited_at", "yyyy-MM-dd'T'HH-mm-ss"))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    return customers.sparkSession.read.schema(rows.schema).parquet(path).select(*rows.columns)
