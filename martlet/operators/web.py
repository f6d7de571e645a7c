"""Web events: JSON lines in, cleaned events out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

from martlet.functions import parse_timestamp
from martlet.operators.skew import first_per_key
from martlet.schemas import WEB_EVENT, WEB_EVENT_KEY, WEB_EVENT_KNOWN_FIELDS


_END = "_end_of_line"
_JSON = {"allowSingleQuotes": "false"}


def _fields() -> Column:
    """Fields of a line that is one JSON object, as text by name; null for anything else.

    The line is read as the first element of a list that ends with a mark of its own: with
    anything behind the object, a second one included, the list is broken or longer.
    """
    listed = F.concat(F.lit("["), F.trim("value"), F.lit(f',{{"{_END}":""}}]'))
    parsed = F.array(F.from_json(listed, "array<map<string,string>>", _JSON))
    whole = F.filter(
        parsed, lambda p: (F.size(p) == 2) & F.map_contains_key(F.try_element_at(p, F.lit(2)), _END)
    )
    return F.try_element_at(F.flatten(whole), F.lit(1))


def _last_of_each(fields: Column) -> Column:
    """A name that a line repeats has its last value."""
    entries = F.map_entries(fields)
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x.key == e.key),
    )
    repeated = F.size(F.array_distinct(F.map_keys(fields))) < F.size(fields)
    return F.when(repeated, F.map_from_entries(last)).otherwise(fields)


def _fitted(text: Column, kind: DataType) -> Column:
    """The value in its declared type; whole numbers may be written with a fraction of zero."""
    if isinstance(kind, IntegralType):
        number = text.try_cast("decimal(38,9)")
        return F.when(number == F.floor(number), number).try_cast(kind)
    return text.try_cast(kind)


# JSON texts that say nothing; like ``{}`` they give neither event nor fault.
_NOTHING = ["null", "false", "0", "0.0", '""', "[]"]


def split_lines(lines: DataFrame) -> DataFrame:
    """Read each line (``value``) once: ``fields`` of an object, or ``bad`` text of what is none.

    The functions below start from this form, so a run that needs events, bad lines and new
    fields can write it once and read it as columns.
    """
    others = [c for c in lines.columns if c != "value"]
    broken = F.col("fields").isNull() & ~F.trim("value").isin(_NOTHING)
    return lines.select(*others, "value", _fields().alias("fields")).select(
        *others,
        _last_of_each(F.col("fields")).alias("fields"),
        F.when(broken, F.col("value")).alias("bad"),
    )


def events_of(split: DataFrame, known: list[str] = WEB_EVENT_KNOWN_FIELDS) -> DataFrame:
    """Typed events of split lines.

    Every known field becomes a column, null where a line lacks it or its value does not fit;
    all other fields are kept as text in the map ``extra``. The generator drops what is no
    event: a filter would be pushed below the parse and repeat it.
    """
    others = [c for c in split.columns if c not in ("fields", "bad")]
    fields = F.col("fields")
    typed = [
        _fitted(F.try_element_at(fields, F.lit(f.name)), f.dataType).alias(f.name)
        for f in WEB_EVENT
    ]
    rest = F.map_filter(fields, lambda k, v: ~k.isin(known))
    extra = F.when(F.size(_unknown(known)) > 0, rest).alias("extra")
    event = F.when(F.size(fields) > 0, F.array(F.struct(*typed, extra)))
    return split.select(*others, F.inline(event))


def bad_of(split: DataFrame) -> DataFrame:
    return split.where(F.col("bad").isNotNull()).drop("fields").withColumnRenamed("bad", "value")


def unfit_values_of(split: DataFrame) -> DataFrame:
    """How many values are there but do not fit their declared type, by field; none if none."""
    def unfit(name: str, kind: DataType) -> Column:
        text = F.try_element_at("fields", F.lit(name))
        return F.when(text.isNotNull() & _fitted(text, kind).isNull(), F.lit(name))

    names = F.filter(F.array(*[unfit(f.name, f.dataType) for f in WEB_EVENT]), lambda n: n.isNotNull())
    return split.select(F.explode(names).alias("field")).groupBy("field").agg(
        F.count(F.lit(1)).alias("affected")
    )


def new_fields_of(split: DataFrame, known: list[str] = WEB_EVENT_KNOWN_FIELDS) -> DataFrame:
    return split.select(F.explode(_unknown(known)).alias("field")).distinct()


def _unknown(known: list[str]) -> Column:
    """Undeclared field names; known ones are removed before anything is grouped."""
    return F.array_except(F.map_keys("fields"), F.array(*[F.lit(k) for k in known]))


def parse_events(lines: DataFrame, known: list[str] = WEB_EVENT_KNOWN_FIELDS) -> DataFrame:
    """Lines (``value`` and any bookkeeping columns) → events; see ``events_of``.

    ``{}`` and lines that are not JSON objects give no event.
    """
    return events_of(split_lines(lines), known)


def bad_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not a JSON object, the empty line included."""
    return bad_of(split_lines(lines))


def new_fields(lines: DataFrame, known: list[str] = WEB_EVENT_KNOWN_FIELDS) -> DataFrame:
    """Names of the fields nobody declared."""
    return new_fields_of(split_lines(lines), known)


def drop_null_customers(events: DataFrame) -> DataFrame:
    return events.where(F.col("customer_id").isNotNull())


def _whole_second(text: Column) -> Column:
    # Text that is no timestamp stays its own key, so unreadable events are not merged.
    return F.coalesce(F.substring(parse_timestamp(text).cast("string"), 1, 19), text)


def event_key(mode: str, timestamp: str = "timestamp") -> list[Column]:
    """What makes two events copies: session, type and the timestamp text.

    ``exact`` compares the text as it stands, ``second`` the whole seconds it names.
    """
    if mode not in ("exact", "second"):
        raise ValueError(f"unknown dedup mode: {mode}")
    text = F.col(timestamp).cast("string")
    return [
        F.col("session_id"),
        F.col("event_type"),
        text if mode == "exact" else _whole_second(text),
    ]


def dedup_events(events: DataFrame, arrival: list[str], mode: str = "exact") -> DataFrame:
    """First event by arrival of each key."""
    if mode == "exact":
        return first_per_key(events, WEB_EVENT_KEY, arrival)
    stamped = events.withColumn("_second", event_key(mode)[2])
    return first_per_key(stamped, ["session_id", "event_type", "_second"], arrival).drop("_second")


def parse_event_time(events: DataFrame) -> DataFrame:
    """Timestamp text → timestamp and event_date, null where the text is no timestamp."""
    return events.withColumn("timestamp", parse_timestamp(F.col("timestamp"))).withColumn(
        "event_date", F.to_date("timestamp")
    )


def clean_web_events(events: DataFrame, arrival: list[str], dedup: str = "exact") -> DataFrame:
    """Drop events without a customer, keep the first of each copy, parse the time.

    Events whose time cannot be read go on with a null time; see ``undated_events``.
    """
    kept = dedup_events(drop_null_customers(events), arrival, dedup)
    return parse_event_time(kept).drop(*arrival)


def dated_events(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("event_date").isNotNull())


def undated_events(cleaned: DataFrame) -> DataFrame:
    """Quarantine: events whose timestamp text could not be read."""
    return cleaned.where(F.col("event_date").isNull())
