"""Transactions and scores derived from the given `events` table; shared by the registered queries and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens import schema


def transactions_sql(source: str = "events", limit: int = 150) -> str:
    """The same text runs in Spark SQL and in DuckDB; rows with a value of at least `limit` are mostly fraud."""
    return f"""
select event_id as tx_id,
       cast((day(ts)-1)*24 + hour(ts) as int) as step,
       case event_type when 'purchase' then 'TRANSFER' when 'error' then 'CASH_OUT'
                       when 'view' then 'PAYMENT' when 'click' then 'DEBIT' else 'CASH_IN' end as type,
       cast(round(value*2000, 0) as float) as amount,
       concat('C', cast(user_id as string)) as nameOrig,
       concat('M', cast(event_id % 1000 as string)) as nameDest,
       cast(case when event_id % 50 = 0 then null else (user_id % 100) * 1000 end as float) as oldbalanceOrg,
       cast((user_id % 90) * 1000 as float) as newbalanceOrig,
       cast((event_id % 80) * 1000 as float) as oldbalanceDest,
       cast((event_id % 70) * 1000 as float) as newbalanceDest,
       cast(case when value >= {limit} and event_id % 4 <> 0 then 1 else 0 end as int) as isFraud,
       cast(case when value >= 400 then 1 else 0 end as int) as isFlaggedFraud
from {source}"""


def transactions(spark: SparkSession, sf_dir: str, limit: int = 150) -> DataFrame:
    return spark.sql(transactions_sql("{events}", limit), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def scored(kept: DataFrame, scale: float = 300_000.0, digits: int = 6) -> DataFrame:
    """(tx_id, label, p) with a closed-form score that rises with the amount, so no model is involved."""
    x = F.col("amount").cast("double")
    return kept.select(schema.KEY, F.col(schema.LABEL).cast("int").alias("label"),
                       F.round(x / (x + scale), digits).alias("p"))
