"""Semi-structured payloads as VARIANT (R1-R9, Q4): typed extraction that
turns a bad cast into NULL plus an issue tag, and a report of payload paths
that no table has a column for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail import schemas as S
from shoptrail.operators.validate import processed_filter

PAYLOAD = "payload"
BAD_JSON, BAD_CAST = "bad_json", "bad_cast:"


def with_variant(raw: DataFrame, col: str = "event_data") -> DataFrame:
    """The payload text parsed once; text that is no JSON gives NULL."""
    return raw.withColumn(PAYLOAD, F.try_parse_json(F.col(col)))


def _field(payload: Column, name: str, dtype: T.DataType) -> Column:
    return F.try_variant_get(payload, f"$.{name}", dtype.simpleString())


def extract(raw: DataFrame, fields: list[T.StructField], col: str = "event_data") -> DataFrame:
    """Adds a typed column for each field (a missing path, a JSON null or a
    value of another type gives NULL) and ``payload_issues``: ``bad_json``, and
    ``bad_cast:<field>`` for a value that is there but has no such type."""
    payload = F.col(PAYLOAD)
    bad = [F.when(_present(payload, f.name) & _field(payload, f.name, f.dataType).isNull(), F.lit(BAD_CAST + f.name)) for f in fields]
    broken = F.when(F.col(col).isNotNull() & payload.isNull(), F.lit(BAD_JSON))
    tags = F.array_compact(F.array(broken, *bad))
    return with_variant(raw, col).withColumns({f.name: _field(payload, f.name, f.dataType) for f in fields} | {"payload_issues": tags})


def _present(payload: Column, name: str) -> Column:
    inner = F.try_variant_get(payload, f"$.{name}", "variant")
    return inner.isNotNull() & ~F.is_variant_null(inner)


def payload_fields(*names: str) -> list[T.StructField]:
    """Fields of the payload schema by name."""
    return [S.PAYLOAD_SCHEMA[n] for n in names]


def route(raw: DataFrame, types: list[str], names: list[str]) -> DataFrame:
    """R1-R5 from VARIANT: the envelope, the named payload fields and their
    issues, for the valid events of these types."""
    envelope = ["event_id", "event_type", "session_id", "customer_id", "timestamp"]
    return extract(processed_filter(raw, types), payload_fields(*names)).select(*envelope, *names, "payload_issues")


def items(raw: DataFrame, path: str = "items") -> DataFrame:
    """R7 from VARIANT: one row for each element of an array in the payload,
    with its position; anything but an array has none."""
    spark = raw.sparkSession
    parsed = with_variant(raw).withColumn("_items", F.try_variant_get(F.col(PAYLOAD), f"$.{path}", "variant"))
    each = parsed.lateralJoin(spark.tvf.variant_explode(F.col("_items").outer()))
    item = {"product_id": "string", "price": "decimal(10,2)", "quantity": "int"}
    return each.where("key is null").select(
        F.concat_ws("_", "event_id", F.col("pos").cast("string")).alias("purchase_item_id"), "event_id",
        *[F.try_variant_get(F.col("value"), f"$.{n}", t).alias(n) for n, t in item.items()])


def drift(raw: DataFrame, known: list[str] | None = None, col: str = "event_data") -> DataFrame:
    """Top-level payload paths that ``known`` (the payload schema's fields)
    does not name: event_type, path, events that have it and the one type that
    fits all its values. Grouped with partial aggregation; no path is capped."""
    spark = raw.sparkSession
    names = known if known is not None else [f.name for f in S.PAYLOAD_SCHEMA.fields]
    each = with_variant(raw, col).lateralJoin(spark.tvf.variant_explode(F.col(PAYLOAD).outer()))
    return (each.where(F.col("key").isNotNull() & ~F.col("key").isin(*names))
            .groupBy("event_type", F.col("key").alias("path"))
            .agg(F.count(F.lit(1)).alias("events"), F.schema_of_variant_agg("value").alias("value_type")))
