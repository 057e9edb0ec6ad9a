"""The whole chain: weighted tables, quota sample, ladders, traits, validation, frozen sample.

``Bundle`` holds the source tables; ``sample`` makes records, ``validate`` compares them with the
tables, ``release`` freezes a part and stops where a gate fails. Every draw is a hash of seed, field and
row, so a change of one table moves only the columns drawn from it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.functions.buckets import right_closed_bin
from strataforge.functions.hashing import payload, uniform, uuid5
from strataforge.operators import compare, flow, ladder, quota
from strataforge.operators.joins import numbered

NAMESPACE = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the UUID namespace for OIDs
TRAITS = ("openness", "conscientiousness", "extraversion", "agreeableness", "neuroticism")


@dataclass(frozen=True)
class Bundle:
    """Weighted tables with ``count`` and ``suppressed``: places, one ladder table a field, and a marginal."""

    place: DataFrame  # place, count: where records live
    fields: dict[str, tuple[DataFrame, list[ladder.Level]]]  # drawn in order; later levels may use earlier fields
    marginal: tuple[str, DataFrame]  # name; (name, count, eligible): met exactly over all records


def normal(data: Column, more: Column, mean: float = 50.0, sd: float = 10.0) -> Column:
    """A normal draw from two independent hash draws."""
    u = F.greatest(uniform(data), F.lit(2.0**-64))
    return mean + sd * F.sqrt(-2 * F.log(u)) * F.cos(2 * F.lit(3.141592653589793) * uniform(more))


def sample(bundle: Bundle, rows: int, seed: int) -> DataFrame:
    """``rows`` records: id, place, fields with the level of each, traits with labels, and the marginal."""
    places = quota.largest_remainder(bundle.place.filter(F.col("count") > 0), ["place"], "count", rows).select("place", "quota")
    out = numbered(quota.expanded(places).select("place", "copy"), ["place", "copy"], None, "row")
    out = out.withColumn("id", uuid5(NAMESPACE, payload(str(seed), F.col("row"))))
    for name, (table, levels) in bundle.fields.items():
        out = ladder.ladder_draw(out, table, levels, name, payload(str(seed), name, F.col("row")))
    for t in TRAITS:
        score = F.least(F.greatest(normal(payload(str(seed), t, F.col("row")), payload(str(seed), f"{t}/2", F.col("row"))), F.lit(20.0)), F.lit(80.0))
        out = out.withColumn(t, F.round(score, 4)).withColumn(f"{t}_label", right_closed_bin(F.col(t), [45.0, 55.0], ["low", "average", "high"], 20.0, 80.0))
    name, marginal = bundle.marginal
    kept = quota.audited_marginal(marginal, name, "count", None)
    slots = quota.shuffled_slots(quota.largest_remainder(kept, [name], "count", rows).select(name, "quota"), [name], f"{seed}:{name}").select(name, F.col("slot").alias("row"))
    return out.join(slots, "row").drop("copy")


def validate(records: DataFrame, bundle: Bundle, tv_limit: float = 0.02, backoff_limit: float = 0.01, correlation_limit: float = 0.02) -> DataFrame:
    """Report rows: total variation of each field and the marginal, back-off rates, trait correlations and bounds, unique ids."""
    parts = []
    for name, (table, levels) in bundle.fields.items():
        fitted = table.filter((F.col("count") > 0) & ~F.col("suppressed")).select(name, "count")
        tv = compare.total_variation(records.select(name), fitted, [name], None, "count")
        parts.append(compare.metric(f"{name}: total variation", tv, "total_variation", tv_limit))
        backed = records.agg(F.avg((F.col(f"{name}_level") != levels[0].name).cast("double")).alias("rate"))
        parts.append(compare.metric(f"{name}: backed off", backed, "rate", backoff_limit))
    name, marginal = bundle.marginal
    tv = compare.total_variation(records.select(name), marginal.filter("eligible").select(name, "count"), [name], None, "count")
    parts.append(compare.metric(f"{name}: total variation", tv, "total_variation", tv_limit))
    corr = compare.max_correlation(records, list(TRAITS)).agg(F.max(F.abs("correlation")).alias("c"))
    parts.append(compare.metric("traits: correlation", corr, "c", correlation_limit))
    parts.append(compare.metric("traits: out of bounds", compare.out_of_bounds(records, list(TRAITS), 20.0, 80.0), "out_of_bounds", 0))
    ids = records.agg((F.count(F.lit(1)) - F.countDistinct("id")).alias("n"))
    parts.append(compare.metric("ids: repeated", ids, "n", 0))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def release(bundle: Bundle, rows: int, frozen_rows: int, seed: int, **limits: float) -> tuple[DataFrame, DataFrame]:
    """(frozen sample, report). A report with a failed row stops the chain before anything is frozen."""
    records = sample(bundle, rows, seed).persist()
    report = validate(records, bundle, **limits)
    failed = [r["name"] for r in report.filter("not passed").collect()]
    if failed:
        raise ValueError(f"gates failed: {failed}")
    return flow.frozen(records, ["place"], bundle.marginal[0], "id", frozen_rows), report
