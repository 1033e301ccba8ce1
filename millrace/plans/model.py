"""Churn regression on snapshot features, fitted and applied with Spark ML."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.semantics import datediff_boundary
from millrace.plans.relational import since
from millrace.sources.retail import day, ntz

NUMERIC = ["spend", "orders", "recency", "signup_day"]


def features(snapshot: DataFrame) -> DataFrame:
    """Numeric inputs from a snapshot that also carries ``country`` and ``signup_ts``."""
    return snapshot.withColumns(
        {
            "spend": F.col("total_spend_30d").cast("double"),
            "orders": F.col("order_count_30d").cast("double"),
            "recency": datediff_boundary("day", "last_order_ts", "snapshot_date").cast("double"),
            # An unknown sign-up is a value of its own, before all others.
            "signup_day": F.coalesce(F.unix_date(F.to_date("signup_ts")).cast("double"), F.lit(-1e6)),
        }
    )


def train_churn(labelled: DataFrame, trees: int = 5, depth: int = 3, seed: int = 11) -> PipelineModel:
    """Squared-error regression of ``target``. ``labelled`` is read once per boosting
    round, so pass a staged table."""
    pipeline = Pipeline(
        stages=[
            StringIndexer(inputCol="country", outputCol="country_no", handleInvalid="keep"),
            # One column a country, so their number is not bound by the bins of a tree.
            OneHotEncoder(inputCol="country_no", outputCol="country_at", handleInvalid="keep", dropLast=False),
            VectorAssembler(inputCols=[*NUMERIC, "country_at"], outputCol="features"),
            GBTRegressor(
                featuresCol="features", labelCol="target", lossType="squared", maxIter=trees, maxDepth=depth,
                seed=seed, checkpointInterval=-1,
            ),
        ]
    )
    return pipeline.fit(features(labelled))


def score(model: PipelineModel, snapshot: DataFrame) -> DataFrame:
    """Add ``churn_score``, clamped to 0..1."""
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("prediction")))
    return model.transform(features(snapshot)).withColumn("churn_score", clamped.cast("decimal(5,4)"))


def labelled_history(orders: DataFrame, customers: DataFrame, upper: datetime, snapshots: int = 4, horizon: int = 90) -> DataFrame:
    """Past snapshots, each customer labelled 1 when no order follows within the horizon.

    One pass over the orders serves all snapshots: an order lands in each snapshot
    whose feature window or label window holds it.
    """
    who = customers.select("customer_id", "country", "signup_ts")
    ends = [upper - timedelta(days=horizon * (i + 1)) for i in range(snapshots)]
    span = orders.where(F.col("order_ts") >= since(ends[-1], "30 days"))
    tags = []
    for end in ends:
        before = (F.col("order_ts") >= since(end, "30 days")) & (F.col("order_ts") < ntz(end))
        after = (F.col("order_ts") >= ntz(end)) & (F.col("order_ts") < ntz(end + timedelta(days=horizon)))
        entry = F.struct(day(end.date()).alias("snapshot_date"), before.alias("before"))
        tags.append(F.when(before | after, entry))
    tagged = span.select("customer_id", "order_ts", "total_amount", F.explode(F.array(*tags)).alias("t")).where("t is not null")
    before = F.col("t.before")
    per_customer = (
        tagged.groupBy("customer_id", F.col("t.snapshot_date").alias("snapshot_date"))
        .agg(
            F.sum(F.when(before, F.col("total_amount"))).cast("decimal(18,2)").alias("total_spend_30d"),
            F.count_if(before).cast("int").alias("order_count_30d"),
            F.max(F.when(before, F.col("order_ts"))).alias("last_order_ts"),
            F.count_if(~before).alias("later"),
        )
        .where(F.col("order_count_30d") > 0)
    )
    return per_customer.join(who, "customer_id").withColumn("target", F.when(F.col("later") == 0, 1.0).otherwise(0.0))
