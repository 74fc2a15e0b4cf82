"""Validation, dead-letter split, projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail import schemas as S
from shoptrail.functions.events import is_valid_event


def _time_col(df: DataFrame, name: str) -> Column:
    """Event time as TIMESTAMP_NTZ whether the column is text or a timestamp."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.col(name).cast("timestamp_ntz")
    return F.col(name)


def normalize_dialects(df: DataFrame) -> DataFrame:
    """Bring flat and rich wire events to one envelope.

    ``event_timestamp`` <- coalesce(event_timestamp, timestamp);
    ``amount`` <- coalesce(amount, payload total_amount, price x quantity).
    Missing columns are treated as NULL.
    """
    cols = set(df.columns)

    def c(name, dtype="string"):
        return F.col(name) if name in cols else F.lit(None).cast(dtype)

    payload = F.from_json(c("event_data"), S.PAYLOAD_SCHEMA) if "event_data" in cols else None
    pay_amount = (F.coalesce(payload["total_amount"].cast("string"),
                             (payload["product_price"] * payload["quantity"]).cast("string"))
                  if payload is not None else F.lit(None).cast("string"))
    ts = F.coalesce(c("event_timestamp").cast("string"), c("timestamp").cast("string"))
    return (df.withColumn("event_timestamp", ts)
              .withColumn("amount", F.coalesce(c("amount").cast("string"), pay_amount)))


def with_validity(df: DataFrame, as_of=None, out: str = "is_valid_event",
                  event_time: str = "event_timestamp", valid_types=None, strict: bool = False) -> DataFrame:
    """F1 as a column: adds ``out`` (boolean, never NULL)."""
    cols = set(df.columns)
    return df.withColumn(out, is_valid_event(
        customer_id="customer_id", event_type="event_type",
        amount="amount" if "amount" in cols else F.lit(None),
        currency="currency" if "currency" in cols else F.lit(None),
        event_time=_time_col(df, event_time), declared="is_valid",
        as_of=as_of, valid_types=valid_types, strict=strict))


def split_valid(df: DataFrame, as_of=None, event_time: str = "event_timestamp",
                valid_types=None) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) with the same columns; invalid is the dead-letter."""
    flagged = with_validity(df, as_of=as_of, event_time=event_time, valid_types=valid_types)
    valid = flagged.filter(F.col("is_valid_event")).drop("is_valid_event")
    invalid = flagged.filter(~F.col("is_valid_event")).drop("is_valid_event")
    return valid, invalid


def parse_wire(df: DataFrame, value_col: str = "value", schema: T.StructType = S.FLAT_EVENT_SCHEMA) -> DataFrame:
    """decode JSON text; undecodable messages keep ``_corrupt_record``
    (and no fields) instead of failing the batch."""
    parsed = F.from_json(F.col(value_col).cast("string"), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    ok = F.try_parse_json(F.col(value_col).cast("string")).isNotNull()
    out = df.withColumn("_e", parsed).withColumn("_ok", ok)
    return out.select(
        *[F.when(F.col("_ok"), F.col("_e")[f.name]).alias(f.name) for f in schema.fields],
        F.when(~F.col("_ok"), F.col(value_col).cast("string")).alias("_corrupt_record"),
        *[c for c in df.columns if c != value_col])


def processed_filter(df: DataFrame, types: list[str]) -> DataFrame:
    """rows of the given types whose ``is_valid`` is TRUE (NULL excluded)."""
    return df.filter(F.col("event_type").isin(*types) & (F.col("is_valid") == F.lit(True)))


def on_day(df: DataFrame, ts: str, day) -> DataFrame:
    """``DATE(ts) = day`` written as a range so Parquet can prune on ts."""
    start = F.lit(str(day)).cast("date").cast("timestamp_ntz")
    return df.filter((F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 DAY")))


def silver_projection(df: DataFrame) -> DataFrame:
    """the six-column silver shape, upper-cased names."""
    cols = ["event_id", "customer_id", "event_type", "amount", "currency", "event_timestamp"]
    return df.select(*[F.col(c).alias(c.upper()) for c in cols])


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """F8/K4: flatten nested structs to top-level columns ``a{sep}b``; arrays stay."""
    def walk(dtype, path):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(f.dataType, path + [f.name])
        else:
            yield path
    cols = []
    for f in df.schema.fields:
        for path in walk(f.dataType, [f.name]):
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))
    return df.select(*cols)


def display_summary(df: DataFrame, payload: str = "event_data") -> DataFrame:
    """per-type display projection as a JSON string column ``summary``."""
    p = F.from_json(F.col(payload), S.PAYLOAD_SCHEMA)
    summary = (F.when(F.col("event_type") == "PURCHASE",
                      F.to_json(F.struct(p["total_amount"].alias("total_amount"), p["order_id"].alias("order_id"))))
               .when(F.col("event_type") == "SEARCH",
                     F.to_json(F.struct(p["search_query"].alias("query"),
                                        p["search_results_count"].alias("results"))))
               .otherwise(F.to_json(F.struct(p["page_url"].alias("page_url")))))
    return df.withColumn("summary", summary)
