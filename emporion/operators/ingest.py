"""Parse Kafka-shaped rows and split them into valid and rejected records.

``parse_*`` work on any DataFrame with the Kafka source columns (``value``
binary, ``timestamp``, ``partition``, ``offset``), batch or streaming.  JSON is
read against a fixed schema (no inference); malformed JSON gives an all-null
record, a bad field only a null field.  Event time is parsed with
``try_to_timestamp`` so one bad string yields NULL (then a rejection) instead
of failing the query under ANSI mode.

``keep_raw=True`` keeps what could not be read: ``raw_value`` is the record as it
came, byte for byte, and ``parse_error`` says whether the value is missing, is no
JSON, or holds a field that is not of its type.  ``rejected`` puts that before the
names of the failed rules, and the quarantine has both columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.rules import Rule, all_pass, click_rules, failed_rule_names, order_rules
from ..functions.timeutil import from_utc_wall, utc_date, utc_wall
from ..schemas import CLICK_WIRE, INVENTORY_WIRE, MONEY, ORDER_WIRE


#: columns that ``keep_raw`` adds
RAW_COLUMNS = ["raw_value", "parse_error"]
_CORRUPT = "_corrupt_record"


def _parse(raw: DataFrame, schema, kafka_meta: bool, processed_at=None, keep_raw: bool = False) -> DataFrame:
    # The record is expanded through a one-element generator: predicates on
    # its fields (the quality rules) then stay above the parse instead of
    # being pushed below it with one JSON re-parse per predicate.
    wire = StructType([*schema.fields, StructField(_CORRUPT, StringType())]) if keep_raw else schema
    record = F.inline(F.array(F.from_json(F.col("value").cast("string"), wire, {"columnNameOfCorruptRecord": _CORRUPT} if keep_raw else {})))
    cols = [record]
    if kafka_meta:
        cols += [F.col("timestamp").alias("kafka_timestamp"), F.col("partition").alias("kafka_partition"),
                 F.col("offset").alias("kafka_offset")]
    if keep_raw:
        cols.append(F.col("value").alias("raw_value"))
    out = raw.select(*cols)
    if keep_raw:
        nothing = _all_null(schema)
        out = out.withColumn("parse_error", F.when(F.col("raw_value").isNull(), "value_missing")
                             .when(F.col(_CORRUPT).isNotNull() & nothing, "json_not_readable")
                             .when(F.col(_CORRUPT).isNotNull(), "field_not_readable")).drop(_CORRUPT)
    ts = F.try_to_timestamp(F.col("event_timestamp"))
    return (out.withColumn("event_timestamp", ts)
               .withColumn("processed_at", processed_at if processed_at is not None else F.current_timestamp())
               .withColumn("event_date", utc_date(F.col("event_timestamp"))))


def _all_null(schema) -> Column:
    out = F.lit(True)
    for name in schema.fieldNames():
        out = out & F.col(name).isNull()
    return out


def parse_orders(raw: DataFrame, processed_at=None, keep_raw: bool = False) -> DataFrame:
    """Order topic rows -> typed order records + Kafka metadata, processed_at,
    event_date (the lake partition column)."""
    return _parse(raw, ORDER_WIRE, kafka_meta=True, processed_at=processed_at, keep_raw=keep_raw)


def parse_clicks(raw: DataFrame, processed_at=None, keep_raw: bool = False) -> DataFrame:
    return _parse(raw, CLICK_WIRE, kafka_meta=False, processed_at=processed_at, keep_raw=keep_raw)


def parse_inventory(raw: DataFrame, processed_at=None, keep_raw: bool = False) -> DataFrame:
    return _parse(raw, INVENTORY_WIRE, kafka_meta=False, processed_at=processed_at, keep_raw=keep_raw)


def valid(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.filter(all_pass(rules))


def rejected(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Records failing at least one rule, with ``reject_reasons``."""
    reasons = failed_rule_names(rules)
    if "parse_error" in df.columns:
        reasons = F.concat_ws(",", F.col("parse_error"), F.when(reasons != "", reasons))
    return df.filter(~all_pass(rules)).withColumn("reject_reasons", reasons)


def valid_orders(parsed: DataFrame) -> DataFrame:
    return valid(parsed, order_rules())


def rejected_orders(parsed: DataFrame) -> DataFrame:
    return rejected(parsed, order_rules())


def valid_clicks(parsed: DataFrame) -> DataFrame:
    return valid(parsed, click_rules())


def rejected_clicks(parsed: DataFrame) -> DataFrame:
    return rejected(parsed, click_rules())


def to_money(df: DataFrame, columns: list[str]) -> DataFrame:
    """Wire doubles -> money as landed.  The type holds any real amount; what is
    none (10**22 and more, infinity; a rule rejects it) becomes NULL instead of
    failing the query."""
    return df.withColumns({c: F.col(c).try_cast(MONEY) for c in columns if c in df.columns})


# ---------------------------------------------------------- Kafka-shaped rows

def _wall(df: DataFrame, c: str):
    col = F.col(c)
    return col if dict(df.dtypes)[c] == "timestamp_ntz" else utc_wall(col)


def _iso(df: DataFrame, ts_col: str):
    c = _wall(df, ts_col)
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def to_kafka_rows(landed: DataFrame, wire_schema, key: str, topic: str, ts: str = "event_timestamp",
                  event_type: str | None = None, partition: str | None = None,
                  offset: str | None = None, kafka_ts: str | None = None) -> DataFrame:
    """Serialise landed rows to the wire (JSON bytes) in the Kafka row shape:
    what a producer puts on the topic.  Used to feed the parsers in batch and
    as file-stream input."""
    fields = []
    for f in wire_schema.fields:
        if f.name == "event_type" and event_type is not None and "event_type" not in landed.columns:
            fields.append(F.lit(event_type).alias("event_type"))
        elif f.name == "event_timestamp":
            fields.append(_iso(landed, ts).alias("event_timestamp"))
        elif f.name in landed.columns:
            fields.append(F.col(f.name).cast(f.dataType).alias(f.name))
    value = F.to_json(F.struct(*fields)).cast("binary")
    return landed.select(
        F.col(key).cast("binary").alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        (F.col(partition) if partition else F.lit(0)).cast("int").alias("partition"),
        (F.col(offset) if offset else F.lit(0)).cast("bigint").alias("offset"),
        from_utc_wall(_wall(landed, kafka_ts or ts)).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
