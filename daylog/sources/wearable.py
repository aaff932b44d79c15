"""Flattening of nested wearable documents into the long text series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_date
from ..functions.text import key_path
from ..operators.latest import last_write_wins
from ..schemas import DAY, SERIES_POINTS, SLEEP_ENTRY

# The member that marks a series as nested by intensity, and the record key of each
# field of a sleep entry.
NESTED_MARK = "very"
SLEEP_KEYS = {
    "duration": "sleep_duration",
    "efficiency": "sleep_efficiency",
    "startTime": "sleep_start",
    "endTime": "sleep_end",
}
# The three series the earliest combine step took.
BASIC_METRICS = ("steps", "distance", "calories_out")
NAMED_SERIES = f"array<struct<metric:string,points:{SERIES_POINTS}>>"


def _opens_with(text: Column, sign: str) -> Column:
    return F.ltrim(text).startswith(sign)


def _members(text: Column) -> Column:
    """Members of a JSON object as text; null for a list."""
    return F.when(_opens_with(text, "{"), F.from_json(text, "map<string,string>"))


def _points(text: Column) -> Column:
    return F.when(_opens_with(text, "["), F.from_json(text, SERIES_POINTS))


def _member_points(members: Column, every_member: bool) -> Column:
    """Points of the first member, or of every member in turn."""
    texts = F.map_values(members)
    if every_member:
        return F.flatten(F.filter(F.transform(texts, _points), lambda points: points.isNotNull()))
    return _points(F.get(texts, F.lit(0)))


def _series(text: Column, every_member: bool) -> Column:
    return F.coalesce(_points(text), _member_points(_members(text), every_member))


def _named(metric: Column, points: Column) -> Column:
    return F.struct(metric.alias("metric"), points.alias("points"))


def _time_series(key: Column, body: Column, qualified: bool) -> Column:
    """Named series of one entry. ``qualified`` names every member ``key_member``, as the legacy store
    does; else only a series nested by intensity is named so and any other goes by its key."""

    def opened(members: Column) -> Column:
        nested = F.coalesce(F.map_contains_key(members, NESTED_MARK), F.lit(False))
        by_member = F.transform(
            F.map_entries(members), lambda m: _named(key_path(key, m.key), _series(m.value, qualified))
        )
        by_key = _named(key, F.coalesce(_points(body), _member_points(members, qualified)))
        return F.when(members.isNotNull() if qualified else nested, by_member).otherwise(F.array(by_key))

    # A list of one binds the parsed members to a name, so the text is parsed once.
    return F.flatten(F.transform(F.array(_members(body)), opened))


def _sleep_series(sleep: Column) -> Column:
    """Sleep entries as four series whose points share the entry's place."""
    entries = F.coalesce(sleep, F.array().cast(f"array<{SLEEP_ENTRY}>"))

    def points(field: str) -> Column:
        return F.transform(
            entries, lambda e: F.struct(e.dateOfSleep.alias("dateTime"), e.getField(field).alias("value"))
        )

    return F.array(*(_named(F.lit(metric), points(field)) for field, metric in SLEEP_KEYS.items()))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once: a list of one binds it to a name."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _placed(series: Column) -> Column:
    """Points of named series as structs (day, metric, place, value); ``day`` is still the text that was written."""

    def of_series(one: Column) -> Column:
        def placed(p: Column, i: Column) -> Column:
            day = F.coalesce(p.dateTime, F.lit(""))
            return F.struct(day.alias("day"), one.metric.alias("metric"), i.alias("place"), p.value.alias("value"))

        return F.transform(F.coalesce(one.points, F.array().cast(SERIES_POINTS)), placed)

    return F.flatten(F.transform(series, of_series))


def _days(points: Column) -> Column:
    """Points of one document as days: structs (day, points) with the last point of each metric.

    A document of one day that names each metric once is a day as it is. Else its points are ordered once by date, metric and
    place; the last point of a metric is the one before a change, and a day is the stretch from one change of date to the next.
    """

    def last_ones(ordered: Column) -> Column:
        def is_last(p: Column, i: Column) -> Column:
            after = F.get(ordered, i + 1)
            return after.isNull() | (after.day != p.day) | (after.metric != p.metric)

        return F.filter(ordered, is_last)

    def stretches(kept: Column) -> Column:
        def begins(i: Column) -> Column:
            return (i == 0) | (F.get(kept, i).day != F.get(kept, i - 1).day)

        def cut(starts: Column) -> Column:
            def day(start: Column, n: Column) -> Column:
                end = F.coalesce(F.get(starts, n + 1), F.size(kept))
                return F.struct(F.get(kept, start).day.alias("day"), F.slice(kept, start + 1, end - start).alias("points"))

            return F.transform(starts, day)

        return _bound(F.filter(F.transform(kept, lambda _, i: i), begins), cut)

    def days(all_points: Column) -> Column:
        one_day = (F.size(F.array_distinct(all_points.day)) == 1) & (F.size(F.array_distinct(all_points.metric)) == F.size(all_points))
        whole = F.struct(F.get(all_points, F.lit(0)).day.alias("day"), all_points.alias("points"))
        return F.when((F.size(all_points) == 1) | one_day, F.array(whole)).otherwise(
            _bound(_bound(F.sort_array(all_points), last_ones), stretches)
        )

    return _bound(points, days)


def _everything(qualified: bool) -> Column:
    """All named series of a document, sleep included; its texts are parsed once."""
    entries = F.map_entries(F.coalesce("time_series", F.create_map().cast("map<string,string>")))
    timed = F.flatten(F.transform(entries, lambda e: _time_series(e.key, e.value, qualified)))
    return F.concat(timed.cast(NAMED_SERIES), _sleep_series(F.col("sleep")).cast(NAMED_SERIES))


def document_points(documents: DataFrame, carry: Sequence[str] = (), qualified: bool = False) -> DataFrame:
    """Documents -> rows (user, date, metric, value, carried columns, place).

    Points without a readable date fall out, and with them sleep entries without a day.
    """
    named = documents.select("user_id", *carry, F.inline(_everything(qualified)))
    points = named.select("user_id", *carry, "metric", F.posexplode("points").alias("place", "point"))
    dated = points.select("user_id", iso_date(F.col("point.dateTime")).alias("date"), "metric", F.col("point.value").alias("value"), *carry, "place")
    return dated.filter(F.col("date").isNotNull())


def document_days(documents: DataFrame, carry: Sequence[str] = (), qualified: bool = False) -> DataFrame:
    """Documents -> one row per document and day (user, date, carried columns, points), reduced inside the document.

    Of several points of a metric on a day the later stays; points without a readable date fall out, and with them sleep
    entries without a day. What is shuffled afterwards are days, not points.
    """
    days = documents.select("user_id", *carry, F.inline(_days(_placed(_everything(qualified)))))
    dated = days.select("user_id", iso_date(F.col("day")).alias("date"), *carry, "points")
    return dated.filter(F.col("date").isNotNull())


def flatten_documents(
    documents: DataFrame,
    order: str = "source_file",
    qualified: bool = False,
    whole_days: bool = True,
    not_before: str | None = None,
) -> DataFrame:
    """Documents -> the text series with one value per user, date and metric.

    Within a document the later point of a metric stays. A later document replaces a day whole, or
    with ``whole_days`` off only the metrics it brings. Whole days are nested inside the document, so one exchange of
    document days decides; else points meet by metric. ``not_before`` names a date column of the documents; days before it
    are late data and fall out.
    """
    carry = [order] if not_before is None else [order, not_before]
    found = (document_days if whole_days else document_points)(documents, carry, qualified)
    if not_before is not None:
        found = found.filter(F.col("date") >= F.col(not_before)).drop(not_before)
    if whole_days:
        newest = last_write_wins(found, DAY, order)
        latest = newest.select(*DAY, order, F.inline("points").alias("_day", "metric", "place", "value"))
        place, document = F.col("place"), F.col(order)
    else:
        marked = found.withColumn("_written", F.struct(F.col(order).alias("document"), "place")).drop(order, "place")
        latest = last_write_wins(marked, [*DAY, "metric"], "_written")
        place, document = F.col("_written.place"), F.col("_written.document")
    return latest.select(*DAY, "metric", "value", place.cast("bigint").alias("seq"), document.cast("string").alias("source"))


def basic_series(series: DataFrame, metrics: Sequence[str] = BASIC_METRICS) -> DataFrame:
    """Only the three series of the earliest combine step, bare or qualified."""
    base = F.regexp_extract("metric", r"^(steps|distance|calories_out)(_activities-.*)?$", 1)
    return series.filter(base.isin(*metrics)).withColumn("metric", base)
