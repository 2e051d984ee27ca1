"""Parsing and validation of raw events, and the dead-letter envelope.

Everything is built from JVM expressions over one scan: text is parsed once, each rule is a predicate and
the first failing rule names the reason. The dimension look-ups broadcast id lists of checked size.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.operators.joins import lookup_join

_KINDS = {
    "orders": (schemas.ORDER_EVENT, schemas.ORDER_REQUIRED, ["quantity", "unit_price"]),
    "inventory": (schemas.INVENTORY_EVENT, schemas.INVENTORY_REQUIRED, ["delta_units", "on_hand_after"]),
}
# Counted in whole units and stored as INT; fractions are cut off.
_UNITS = ("quantity", "delta_units", "on_hand_after")
# The texts of the reasons are fixed values.
PARSE_ERROR = "json_parse_error"
# Year first, then month and day; a time and an offset may follow.
_ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}.*)?$"


def parse_events(raw: DataFrame, kind: str, value: str = "value") -> DataFrame:
    """Tolerant parse. Adds ``event`` (typed struct) and ``present`` (names of the fields the text has).

    ``event`` is NULL when the text is not exactly one JSON object. Wrapping the text in brackets makes
    the parser reject trailing text, which it would otherwise ignore. A text could close that bracket itself, so one
    that holds a closing bracket must also parse as the value of an object, whose end it cannot close as well. The
    field names are read from the text again only when a required field came out NULL.
    """
    event_type, required, _ = _KINDS[kind]
    boxed = F.concat(F.lit("["), F.col(value), F.lit("]"))
    items = F.from_json(boxed, f"array<struct<{_struct_fields(event_type)}>>")
    complete = reduce(lambda a, b: a & b, [F.col(f"event.{c}").isNotNull() for c in required])
    names = F.coalesce(F.json_object_keys(F.col(value)), F.array().cast("array<string>"))
    inside = F.from_json(F.concat(F.lit('{"a":'), F.col(value), F.lit("}")), f"a struct<{_struct_fields(event_type)}>")
    whole = F.when(F.contains(F.col(value), F.lit("]")), inside["a"].isNotNull()).otherwise(True)
    return (
        raw.withColumn("_items", items)
        .withColumn("event", F.when((F.size("_items") == 1) & whole, F.get("_items", F.lit(0))))
        .withColumn("present", F.when(complete, F.array(*[F.lit(c) for c in required])).otherwise(names))
        .drop("_items")
    )


def _struct_fields(ddl: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.strip().split(" ") for f in ddl.split(",")))


def missing_fields(kind: str, present: str = "present") -> Column:
    """Sorted names of required fields that the event lacks; a NULL value still counts as present."""
    required = F.array(*[F.lit(c) for c in _KINDS[kind][1]])
    return F.array_except(required, F.col(present))


def event_timestamp(text: Column) -> Column:
    """ISO-8601 text to timestamp; ``Z`` and offsets are honoured, naive text is UTC, junk is NULL."""
    return F.when(text.rlike(_ISO_SHAPE), F.try_to_timestamp(text))


def with_known_ids(df: DataFrame, stores: DataFrame, skus: DataFrame, value: str = "value") -> DataFrame:
    """Flag whether the event's store and product exist in the dimensions."""
    store_ids = stores.select(F.col("store_id").alias("_store")).distinct().withColumn("store_known", F.lit(True))
    sku_ids = skus.select(F.col("sku_id").alias("_sku")).distinct().withColumn("sku_known", F.lit(True))
    keyed = df.withColumns({"_store": F.col("event.store_id"), "_sku": F.col("event.sku_id")})
    known = lookup_join(keyed, store_ids, ["_store"], [value], sized_by=stores.select("store_id"))
    known = lookup_join(known, sku_ids, ["_sku"], [value], sized_by=skus.select("sku_id"))
    return known.select(
        *[F.col(c) for c in df.columns],
        F.coalesce("store_known", F.lit(False)).alias("store_known"),
        F.coalesce("sku_known", F.lit(False)).alias("sku_known"),
    )


def _number_text(field: str, value: str) -> Column:
    return F.get_json_object(F.col(value), f"$.{field}")


def _invalid_types(kind: str) -> Column:
    """Fields that must be numbers and are not: NULL, text, nested, not finite, or units beyond an INT."""
    def bad(field: str) -> Column:
        number = F.col(f"event.{field}")
        wrong = number.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))
        return wrong | (F.abs(number) > 2**31 - 1) if field in _UNITS else wrong

    return F.array_compact(F.array(*[F.when(bad(c), F.lit(c)) for c in _KINDS[kind][2]]))


def _range_rules(kind: str, value: str) -> list[Column]:
    def failing(field: str, predicate: Column, wanted: str) -> Column:
        return F.when(
            predicate, F.concat(F.lit(f"{field} must be {wanted}, got "), _number_text(field, value))
        )

    if kind == "orders":
        return [
            failing("quantity", F.col("event.quantity") < 1, "> 0"),  # less than one unit would be stored as none
            failing("unit_price", F.col("event.unit_price") < 0, ">= 0"),
        ]
    movement = F.col("event.movement_type")
    allowed = F.coalesce(movement.isin(schemas.MOVEMENT_TYPES), F.lit(False))
    return [
        failing("on_hand_after", F.col("event.on_hand_after") < 0, ">= 0"),
        F.when(~allowed, F.concat(F.lit("unknown movement_type: "), _or_none(movement))),
    ]


def _sound(kind: str) -> Column:
    """Whether an event passes the rules on its own fields. Most do, and this costs less than to look for a reason.

    A NULL outcome counts as not sound; such an event is judged rule by rule.
    """
    _, required, numbers = _KINDS[kind]
    top = F.lit(2.0**31 - 1)  # in place of infinity for units
    checks = [F.col(f"event.{c}").isNotNull() for c in required]
    checks += [F.abs(f"event.{c}") <= top if c in _UNITS else F.abs(f"event.{c}") < float("inf") for c in numbers]
    if kind == "orders":
        return reduce(lambda a, b: a & b, [*checks, F.col("event.quantity") >= 1, F.col("event.unit_price") >= 0])
    return reduce(
        lambda a, b: a & b, [*checks, F.col("event.on_hand_after") >= 0, F.col("event.movement_type").isin(schemas.MOVEMENT_TYPES)]
    )


def _or_none(c: Column) -> Column:
    return F.coalesce(c, F.lit("None"))


def validate(
    parsed: DataFrame,
    kind: str,
    stores: DataFrame,
    skus: DataFrame,
    now: Column | None = None,
    max_future_s: int = 60,
    value: str = "value",
) -> DataFrame:
    """Add ``event_ts`` and ``reason``; ``reason`` is NULL for valid events.

    Rules apply in the order missing fields, types, ranges, movement, store, product, time, future drift.
    ``now`` is a parameter so that batch runs can be repeated; streams leave it out.
    """
    now = F.current_timestamp() if now is None else now
    missing, invalid = missing_fields(kind), _invalid_types(kind)
    event_ts = F.col("event_ts")
    rules = [
        F.when(F.col("event").isNull(), F.lit(PARSE_ERROR)),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing fields: "), F.array_join(missing, ", "))),
        F.when(F.size(invalid) > 0, F.concat(F.lit("invalid type: "), F.array_join(invalid, ", "))),
        *_range_rules(kind, value),
        F.when(~F.col("store_known"), F.concat(F.lit("unknown store_id: "), _or_none(F.col("event.store_id")))),
        F.when(~F.col("sku_known"), F.concat(F.lit("unknown sku_id: "), _or_none(F.col("event.sku_id")))),
        F.when(
            event_ts.isNull(),
            F.concat(F.lit("unparseable event_time: "), _or_none(F.col("event.event_time"))),
        ),
        F.when(
            event_ts > now + F.expr(f"interval {int(max_future_s)} seconds"),
            F.concat(
                F.lit("event_time too far in future: "),
                F.date_format(event_ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                F.lit("+00:00"),
            ),
        ),
    ]
    stamped = parsed.withColumn("event_ts", event_timestamp(F.col("event.event_time")))
    known = with_known_ids(stamped, stores, skus, value)
    soon = now + F.expr(f"interval {int(max_future_s)} seconds")
    sound = _sound(kind) & F.col("store_known") & F.col("sku_known") & F.coalesce(event_ts <= soon, F.lit(False))
    reason = F.when(sound, F.lit(None)).otherwise(F.coalesce(*rules))
    return known.withColumn("reason", reason).drop("store_known", "sku_known")


def valid_events(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reason").isNull())


def dead_letters(
    validated: DataFrame, source_topic: str, failed_at: Column | None = None, value: str = "value"
) -> DataFrame:
    """Envelope of every rejected event, the original text kept."""
    failed_at = F.current_timestamp() if failed_at is None else failed_at
    return validated.filter(F.col("reason").isNotNull()).select(
        F.lit(source_topic).alias("source_topic"),
        "reason",
        failed_at.alias("failed_at"),
        F.col(value).alias("original_event"),
    )


def as_message(df: DataFrame) -> DataFrame:
    """Any frame as one JSON ``value`` column, the shape a topic sink takes."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def _event_time() -> Column:
    """Valid events have a time. Saying so keeps window operators from adding a not-null filter, which the
    optimizer would push below the parse and so parse every text twice."""
    return F.coalesce(F.col("event_ts"), F.lit(datetime(1970, 1, 1, tzinfo=timezone.utc)))


def project_orders(valid: DataFrame) -> DataFrame:
    return valid.select(
        F.col("event.event_id").alias("event_id"),
        F.col("event.store_id").alias("store_id"),
        F.col("event.sku_id").alias("sku_id"),
        _event_time().alias("event_time"),
        F.unix_millis("event_ts").alias("event_ms"),
        F.col("event.quantity").try_cast("int").alias("quantity"),
        F.col("event.unit_price").alias("unit_price"),
        F.coalesce(F.col("event.is_injected_anomaly"), F.lit(False)).alias("is_injected_anomaly"),
    )


def project_inventory(valid: DataFrame) -> DataFrame:
    return valid.select(
        F.col("event.event_id").alias("event_id"),
        F.col("event.store_id").alias("store_id"),
        F.col("event.sku_id").alias("sku_id"),
        _event_time().alias("event_time"),
        F.unix_millis("event_ts").alias("event_ms"),
        F.col("event.movement_type").alias("movement_type"),
        F.col("event.delta_units").try_cast("int").alias("delta_units"),
        F.col("event.on_hand_after").try_cast("int").alias("on_hand_after"),
    )


def reject_counts(validated: DataFrame) -> DataFrame:
    """Rejects per rule, the part of the reason before its details."""
    rule = F.regexp_extract("reason", r"^([a-z_]+(?: [a-z_]+)*)", 1)
    return validated.filter(F.col("reason").isNotNull()).groupBy(rule.alias("rule")).agg(F.count("*").alias("n"))


def constraint_violations(
    df: DataFrame, table: str, not_null: list[str], key: list[str], enums: dict[str, list[str]] | None = None
) -> DataFrame:
    """Count broken table constraints: NULLs per column, values outside an enumeration, surplus rows per key."""
    enums = enums or {}
    checks = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    checks |= {f"enum:{c}": F.count_if(~F.col(c).isin(v)) for c, v in enums.items()}
    per_key = df.groupBy(*key).agg(F.count("*").alias("_rows"))
    keyed = per_key.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).cast("long").alias("n")).select(
        F.lit("primary_key:" + ",".join(key)).alias("rule"), "n"
    )
    if checks:
        counts = df.agg(*[e.alias(n) for n, e in checks.items()])
        keyed = keyed.unionByName(counts.unpivot([], [f"`{n}`" for n in checks], "rule", "n"))
    return keyed.select(F.lit(table).alias("table_name"), "rule", "n")
