"""The chain over the shared tables: nations are places, segments and priorities the fields, brands the marginal."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.operators.ladder import Level
from strataforge.plans import standard
from strataforge.plans.registry import query
from strataforge.plans.sampling_queries import _NATIONS, _lr


def _bundle(t) -> standard.Bundle:
    place = t.customer.groupBy(F.col("c_nationkey").alias("place")).agg(F.count(F.lit(1)).alias("count"))
    people = t.customer.select("c_custkey", F.col("c_nationkey").alias("place"), F.col("c_mktsegment").alias("segment"))
    cells = lambda df, keys: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).withColumn("suppressed", F.lit(False))
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("priority")).join(people, "c_custkey")
    brand = t.part.groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("count")).withColumn("eligible", F.col("count") >= 1)
    fields = {
        "segment": (cells(people, ["place", "segment"]), [Level("place", ("place",)), Level("all", ())]),
        "priority": (cells(orders, ["place", "segment", "priority"]), [Level("place_segment", ("place", "segment")), Level("segment", ("segment",)), Level("all", ())]),
    }
    return standard.Bundle(place, fields, ("brand", brand))


@query()
def standard_sample(t):
    return standard.sample(_bundle(t), 2000, 20260914)


@query()
def standard_report(t):
    bundle = _bundle(t)
    return standard.validate(standard.sample(bundle, 2000, 20260914).persist(), bundle, tv_limit=0.05, correlation_limit=0.1)


@query()
def standard_release(t):
    frozen, _ = standard.release(_bundle(t), 2000, 200, 20260914, tv_limit=0.05, correlation_limit=0.1)
    return frozen


@query(f"""
SELECT 'place' AS kind, c_nationkey::VARCHAR AS value, quota AS n FROM {_lr(_NATIONS, 'c_nationkey', '2000')} WHERE quota > 0
UNION ALL SELECT 'brand', p_brand, quota FROM {_lr('(SELECT p_brand, count(*) AS n FROM part GROUP BY 1)', 'p_brand', '2000')} WHERE quota > 0
UNION ALL SELECT 'ids', 'distinct', 2000""")
def standard_sample_margins(t):
    """Places and the marginal of the sample meet their quotas exactly, and ids are distinct."""
    rows = standard_sample(t)
    each = lambda c, kind: rows.groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "value", "n")
    return each("place", "place").unionByName(each("brand", "brand")).unionByName(rows.agg(F.countDistinct("id").alias("n")).select(F.lit("ids").alias("kind"), F.lit("distinct").alias("value"), "n"))
