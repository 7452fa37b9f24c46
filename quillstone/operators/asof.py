"""Attributes as known at event time, by validity intervals in time buckets.

An attribute row counts from the later of its own day and the day on which it became known. Per entity, the best row so far (latest own day,
then last known) changes only at such days; each change begins a half-open interval that the next one ends. Intervals are exploded into
time buckets and events find theirs by an equi-join on (entity, bucket) plus containment, so no event can see a value from its future. An interval that is
open at its end, or would fill more than ``LONG`` buckets, goes into one bucket of its own kind, which every event asks besides that of its day: intervals
of an entity and attribute don't overlap, so an entity has few of them whatever dates its events bear.

All attributes are rows of one set of intervals and one join. Only distinct (entity, day) pairs of the events take part in it; they are combined map-side
first, which turns an entity with a third of all events into at most one row per calendar day. The events then pick up the answers by an equi-join on (entity,
day), whose right side has a row per attribute, so a hot pair is split by the engine's skew handling at no cost but a copy of these.

Defined results
* an event without entity or day, or with nothing known by then, gives no row. Null attribute values are never candidates.
* of rows with equal own day and equal time of knowledge the greater value is taken.
* repeated attribute rows change nothing; repeated events are one. Empty inputs give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 64
LONG = 16
_APART = -(1 << 30)


def daily_best(df: DataFrame, attribute: str, entity: Column, own_day: Column, known_at: Column, value: Column) -> DataFrame:
    """(attribute, entity, valid_from, best): the best row that begins to count on each day. Map-side combined and bounded by the calendar."""
    rows = df.select(entity.alias("entity"), own_day.cast("date").alias("own_day"), known_at.cast("timestamp_ntz").alias("known_at"), value.alias("value"))
    rows = rows.filter(" and ".join(f"{c} is not null" for c in rows.columns))
    best = F.max(F.struct("own_day", "known_at", "value")).alias("b")
    daily = rows.groupBy("entity", F.greatest("own_day", F.col("known_at").cast("date")).alias("valid_from")).agg(best)
    return daily.select(F.lit(attribute).alias("attribute"), "entity", "valid_from", F.struct("b.own_day", "b.known_at", F.col("b.value").cast("string").alias("value")).alias("best"))


def intervals(*daily: DataFrame) -> DataFrame:
    """(attribute, entity, valid_from, valid_to, best): what was best known from which day on; valid_to is null for what still holds."""
    rows = reduce(DataFrame.unionByName, daily)
    by_day = Window.partitionBy("attribute", "entity").orderBy("valid_from")
    # values don't decide any more: rows of equal own day and time of knowledge begin on the same day and were reduced to one
    running = rows.withColumn("best", F.max("best").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    running = running.withColumn("before", F.lag("best").over(by_day)).filter("before is null or before <> best")
    return running.select("attribute", "entity", "valid_from", F.lead("valid_from").over(by_day).alias("valid_to"), "best")


def _bucket(c: Column | str, days: int) -> Column:
    return F.floor(F.unix_date(c) / F.lit(days)).cast("int")


def resolve(pairs: DataFrame, valid: DataFrame, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """Answers (entity, day, attribute, best) for distinct (entity, day) pairs."""
    first, last = _bucket("valid_from", bucket_days), _bucket(F.date_sub("valid_to", 1), bucket_days)
    buckets = F.when(last - first < LONG, F.sequence(first, last)).otherwise(F.array(F.lit(_APART)))
    spread = valid.withColumn("bucket", F.explode(buckets)).alias("v")
    asked = pairs.withColumn("bucket", F.explode(F.array(_bucket("day", bucket_days), F.lit(_APART)))).alias("p")
    inside = (F.col("p.entity") == F.col("v.entity")) & (F.col("p.bucket") == F.col("v.bucket")) & (F.col("p.day") >= F.col("v.valid_from")) & (F.col("v.valid_to").isNull() | (F.col("p.day") < F.col("v.valid_to")))
    return asked.join(spread, inside).select("p.entity", "p.day", "v.attribute", "v.best")


def as_known(events: DataFrame, entity: Column, day: Column, valid: DataFrame, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """Events with one row per attribute known on their day: attribute, own_day, known_at and value (as text), once per distinct event.

    All attributes are looked up beside each other, so the events are read and shuffled once; ``entity`` and ``day`` hold the keys used. Columns of the events
    that bear one of the added names give way."""
    kept = [c for c in events.columns if c not in ("entity", "day", "attribute", "own_day", "known_at", "value", "__entity", "__day", "__best")]
    keyed = events.select(*kept, entity.alias("__entity"), day.cast("date").alias("__day")).filter("__entity is not null and __day is not null")
    pairs = keyed.select(F.col("__entity").alias("entity"), F.col("__day").alias("day")).distinct()
    answers = resolve(pairs, valid, bucket_days).select(F.col("entity").alias("__entity"), F.col("day").alias("__day"), "attribute", F.col("best").alias("__best"))
    # partitioned by the keys already, so that dropping repeated events moves nothing
    found = keyed.join(answers, ["__entity", "__day"]).distinct()
    return found.select(*kept, F.col("__entity").alias("entity"), F.col("__day").alias("day"), "attribute", "__best.own_day", "__best.known_at", "__best.value")
