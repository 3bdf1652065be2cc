"""Black lists of devices and cards that change: additions and removals, and who was listed when.

A change log has a row per change: ``list`` (``device`` or ``card``), ``id``,
``listed`` (true adds, false removes) and ``at``.  Of changes of one id at one
time a removal counts.  A change is valid from its time on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: name of a list: the key of an event, and the flag it sets
LISTS = {"device": ("device_id", "is_black_device"), "card": ("card_id", "is_black_card")}


def intervals(changes: DataFrame) -> DataFrame:
    """``list``, ``id``, ``valid_from`` and ``valid_to`` (null while still listed): when an id was listed.

    Changes that change nothing, such as a second addition, end no interval.
    """
    one = changes.filter("id IS NOT NULL AND at IS NOT NULL").groupBy("list", "id", F.col("at").cast("timestamp").alias("at")).agg(
        F.min("listed").alias("listed")
    )
    order = Window.partitionBy("list", "id").orderBy("at")
    turns = one.withColumn("_was", F.lag("listed").over(order)).filter("_was IS NULL OR _was <> listed")
    until = turns.withColumn("valid_to", F.lead("at").over(order))
    return until.filter("listed").select("list", "id", F.col("at").alias("valid_from"), "valid_to")


def listed_at(events: DataFrame, changes: DataFrame, at: str = "event_ts") -> DataFrame:
    """Events with the two flags also set by the lists as they were at the time ``at`` of the event.

    An interval that ended is spread over the days it covers, so an event meets
    by equality those of its own id and day; an id has at most one that has not
    ended.  No broadcast is forced, and a hot device or card is split by the
    runtime skew handling.
    """
    when = intervals(changes)
    for name, (key, flag) in LISTS.items():
        own = when.filter(F.col("list") == name)
        days = F.explode(F.sequence(F.to_date("valid_from"), F.to_date("valid_to")))
        ended = own.filter("valid_to IS NOT NULL").select(F.col("id").alias("_id"), days.alias("_on"), "valid_from", "valid_to")
        lasting = own.filter("valid_to IS NULL").select(F.col("id").alias("_id"), F.col("valid_from").alias("_since"))
        time = events[at]
        met = (events[key] == ended["_id"]) & (F.to_date(time) == ended["_on"]) & (time >= ended["valid_from"]) & (time < ended["valid_to"])
        found = events.join(ended, met, "left").select(*[events[c] for c in events.columns], ended["_id"].isNotNull().alias("_past"))
        joined = found.join(lasting, (found[key] == lasting["_id"]) & (found[at] >= lasting["_since"]), "left")
        listed = F.col("_past") | lasting["_id"].isNotNull() | F.coalesce(found[flag], F.lit(False))
        events = joined.select(*[listed.alias(c) if c == flag else found[c] for c in events.columns])
    return events


def listed_events(events: DataFrame, changes: DataFrame, at: str = "event_ts") -> DataFrame:
    """Only events that are flagged, by themselves or by a list of their time."""
    return listed_at(events, changes, at).filter("is_black_device OR is_black_card")
