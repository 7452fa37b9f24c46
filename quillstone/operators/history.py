"""Full history of changing attributes by consecutive snapshot differencing.

A state of the entities at a day is what was stated on that day together with what is carried forward to it. Each state is compared with the state before it
by a full outer join that classifies keys as ``inserted``, ``changed``, ``deleted`` or equal; equal ones drop out. Only a key that a day states can differ from
what is carried to that day, so the carried side is held sparse: a statement is carried to the day of the key's next statement, where it is compared, and
stands for the key in all states between. An update log of n rows thus costs n rows, not n times the number of days. With ``carry=False`` a snapshot says all
there is: a statement is carried to the next delivered day only, and a key that is missing there is deleted and its version ends.

The union of the change events, one per real change and not per snapshot, is the only input of the window that derives validity with ``lead``.

Defined results
* a null value, or a text without letter or digit, states nothing: it neither starts nor ends a version (with ``carry=False`` it ends one, as a missing key
  does). Keys and days are never null here (see below), so the join needs no null-safe keys; values are compared null-safe.
* values compare by ``same`` (for instance letters and digits only); the value shown is the one as written when the version began.
* of several statements of one entity and day the last known counts, of equal times the greater value.
* null entities or days are no statements. Repeated rows change nothing. An empty table gives no versions.

Rows are first reduced to one statement per entity and day (map-side combined, so a hot entity shrinks to at most one row per calendar day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def statements(df: DataFrame, entity: Column, day: Column, known_at: Column, attributes: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Non-null statements (attribute, entity_key, day, known_at, value, same) of rows; ``attributes`` maps a name to its value and the form under which
    values compare. All attributes of a table come from one scan."""
    said = F.array(*[F.struct(F.lit(name).alias("attribute"), value.cast("string").alias("value"), same.cast("string").alias("same")) for name, (value, same) in attributes.items()])
    rows = df.select(entity.cast("string").alias("entity_key"), day.cast("date").alias("day"), known_at.alias("known_at"), F.inline(said))
    return rows.filter(F.col("entity_key").isNotNull() & F.col("day").isNotNull() & F.col("same").isNotNull())


def last_of_day(said: DataFrame) -> DataFrame:
    """One statement per attribute, entity and day: (attribute, entity_key, day, value, same)."""
    last = F.max(F.struct("known_at", "same", "value")).alias("last")
    return said.groupBy("attribute", "entity_key", "day").agg(last).select("attribute", "entity_key", "day", "last.value", "last.same")


def changes(stated: DataFrame, carry: bool = True) -> DataFrame:
    """Events (attribute, entity_key, day, event, value, same, previous) of each state against the state before it."""
    if carry:
        onto = F.lead("day").over(Window.partitionBy("attribute", "entity_key").orderBy("day"))  # at most a row per calendar day
        carried = stated.withColumn("onto", onto)
    else:
        days = stated.select("attribute", "day").distinct()
        following = days.select("attribute", "day", F.lead("day").over(Window.partitionBy("attribute").orderBy("day")).alias("onto"))  # a row per delivered day
        carried = stated.join(following, ["attribute", "day"])
    before = carried.filter("onto is not null").select("attribute", "entity_key", F.col("onto").alias("day"), F.col("value").alias("value0"), F.col("same").alias("same0"), F.lit(True).alias("there"))
    both = stated.withColumn("here", F.lit(True)).join(before, ["attribute", "entity_key", "day"], "full_outer")
    event = F.when(F.col("there").isNull(), "inserted").when(F.col("here").isNull(), "deleted").when(~F.col("same").eqNullSafe(F.col("same0")), "changed")
    return both.withColumn("event", event).filter("event is not null").select("attribute", "entity_key", "day", "event", "value", "same", F.col("value0").alias("previous"))


def versions(stated: DataFrame, carry: bool = True) -> DataFrame:
    """Versions (attribute, entity_key, value, valid_from, valid_to) with half-open validity; valid_to is null for the version that still holds."""
    by_key = Window.partitionBy("attribute", "entity_key").orderBy("day")  # at most one event per calendar day
    dated = changes(stated, carry).select("attribute", "entity_key", "event", "value", F.col("day").alias("valid_from"), F.lead("day").over(by_key).alias("valid_to"))
    return dated.filter("event <> 'deleted'").drop("event")
