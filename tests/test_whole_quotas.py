"""Water filling deals every slot that there is room for."""

import pytest
from pyspark.sql import functions as F

from strataforge.operators import quota, repair


def test_skewed_weights_leave_no_slot(spark):
    cases = [([(i, 10**6 // i**2, 100) for i in range(1, 26)], 2375, 4), ([(i, 10 ** (19 - i), 100000 if i == 19 else 10) for i in range(2, 20)], 1000, 8)]
    for table, slots, rounds in cases:
        df = spark.createDataFrame(table, "k int, w long, room int")
        got = quota.water_filled(df, "k", "w", "room", slots, rounds).collect()
        assert sum(r.quota for r in got) == slots and all(0 <= r.quota <= r.room for r in got)


def test_slots_that_cannot_be_dealt_are_an_error(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 0, 5)], "k string, w int, room int")
    with pytest.raises(Exception, match="slots remain"):
        quota.water_filled(df, "k", "w", "room", 3, 4).collect()
    rows = spark.range(10).select("id", F.lit("s").alias("s"), F.lit("known").alias("e"))
    source = spark.createDataFrame([("s", 1)], "s string, w int")
    with pytest.raises(ValueError, match="to be allocated"):
        repair.allocated_missing(rows, ["s"], "key", F.col("id") < 3, "e", "unknown", source, "w", 0.5, "id", "seed")
