"""Scalar column builders: validation, enrichment, tagging, order arithmetic.

All of these return ``Column`` objects built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoptrail import schemas as S

__all__ = [
    "col_of", "as_of_ts", "parse_event_time", "to_number", "is_valid_event",
    "event_category", "business_value_score", "counter_group", "quality_band",
    "page_title", "python_title", "product_url", "short_key", "issue_tags",
    "order_tax", "order_shipping", "order_total", "full_name", "age_years",
    "days_between", "duration_seconds", "quality_rate", "pct", "money_avg",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_ts(as_of=None) -> Column:
    """The reference clock as TIMESTAMP_NTZ; ``None`` means now."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def parse_event_time(c, strict: bool = False) -> Column:
    """Parse an ISO-8601 event time (string or timestamp) to UTC TIMESTAMP_NTZ.

    Strings with ``Z`` or an offset are parsed as instants and converted to
    UTC wall time (the session time zone is pinned to UTC); strings without
    one are taken as UTC. Unparsable text gives NULL. ``strict=True`` keeps
    the mirrored validator's behaviour of rejecting zone-qualified strings.
    """
    c = col_of(c)
    parsed = c.cast("string").try_cast("timestamp").cast("timestamp_ntz")
    if strict:
        zoned = c.cast("string").rlike(r"(Z|[+-]\d{2}:?\d{2})$")
        return F.when(zoned, F.lit(None).cast("timestamp_ntz")).otherwise(parsed)
    return parsed


def to_number(c, dtype: str = "decimal(18,2)") -> Column:
    """Numeric value of a field that may arrive as text; bad text -> NULL."""
    return col_of(c).cast("string").try_cast(dtype)


def is_valid_event(customer_id="customer_id", event_type="event_type", amount="amount",
                   currency="currency", event_time="event_timestamp", declared="is_valid",
                   as_of=None, valid_types=None, strict: bool = False) -> Column:
    """Stream validator: one boolean column, never NULL.

    Rules: non-empty customer; known type; positive amount and a currency on
    money events; parsable time not later than the clock plus one hour; and
    a declared ``is_valid`` that is exactly TRUE (NULL fails).
    """
    types = valid_types or S.VALID_EVENT_TYPES
    cust = col_of(customer_id)
    etype = col_of(event_type)
    amt = to_number(amount, "decimal(38,6)")
    cur = col_of(currency)
    ts = parse_event_time(event_time, strict=strict)
    money_ok = F.when(
        etype.isin(*S.MONEY_EVENT_TYPES),
        amt.isNotNull() & (amt > 0) & cur.isNotNull() & (cur != F.lit("")),
    ).otherwise(F.lit(True))
    ok = (
        cust.isNotNull() & (cust != F.lit(""))
        & etype.isin(*types)
        & money_ok
        & ts.isNotNull()
        & (ts <= as_of_ts(as_of) + F.expr(S.FUTURE_TOLERANCE))
        & (col_of(declared) == F.lit(True))
    )
    return F.coalesce(ok, F.lit(False))


def _lookup(c, mapping: dict, default) -> Column:
    c = col_of(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(default)


def event_category(event_type="event_type") -> Column:
    return _lookup(event_type, S.EVENT_CATEGORY, F.lit(None).cast("string"))


def business_value_score(event_type="event_type") -> Column:
    return _lookup(event_type, S.BUSINESS_VALUE_SCORE, F.lit(0)).cast("int")


def counter_group(event_type="event_type") -> Column:
    return _lookup(event_type, S.COUNTER_GROUPS, F.lit(None).cast("string"))


def quality_band(score) -> Column:
    s = col_of(score)
    expr = None
    for threshold, label in S.QUALITY_BANDS:
        cond = s >= F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(S.QUALITY_BAND_FALLBACK))


def python_title(c) -> Column:
    """Title-case like Python's ``str.title``: a letter that follows a
    non-letter is upper-cased, every other letter lower-cased."""
    runs = F.regexp_extract_all(col_of(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    cased = F.transform(runs, lambda r: F.when(
        r.rlike(r"^\p{L}"), F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, F.lit(2), F.length(r))))
    ).otherwise(r))
    return F.array_join(cased, "")


def page_title(page_url="page_url") -> Column:
    url = col_of(page_url)
    fallback = F.concat(python_title(F.replace(url, F.lit("/"), F.lit(""))), F.lit(S.PAGE_TITLE_SUFFIX))
    return _lookup(url, S.PAGE_TITLES, fallback)


def product_url(product_id="product_id") -> Column:
    return F.concat(F.lit("/product/"), F.lower(col_of(product_id)))


def short_key(prefix: str, uuid_col) -> Column:
    """``PREFIX_`` + the first 8 characters of a UUID, upper-cased."""
    return F.concat(F.lit(prefix), F.upper(F.substring(col_of(uuid_col), 1, 8)))


def issue_tags(customer_id="customer_id", session_id="session_id", event_time="timestamp",
               amount="amount", product_price="product_price", as_of=None) -> Column:
    """Data-quality issue tags for a row, as ``array<string>`` (empty = clean)."""
    cust = col_of(customer_id)
    ts_raw = col_of(event_time)
    ts = parse_event_time(ts_raw)
    amt = col_of(amount)
    price = to_number(product_price, "decimal(38,6)")
    tags = F.array(
        F.when(cust.isNull() | (cust == F.lit("")), F.lit(S.ISSUE_MISSING_CUSTOMER)),
        F.when(col_of(session_id).isNull(), F.lit(S.ISSUE_MISSING_SESSION)),
        F.when(ts_raw.isNull(), F.lit(S.ISSUE_MISSING_TIMESTAMP)),
        F.when(amt.isNotNull() & to_number(amt, "decimal(38,6)").isNull(), F.lit(S.ISSUE_INVALID_AMOUNT)),
        F.when(ts > as_of_ts(as_of), F.lit(S.ISSUE_FUTURE_TIMESTAMP)),
        F.when(price < 0, F.lit(S.ISSUE_NEGATIVE_PRICE)),
    )
    return F.array_compact(tags)


def order_tax(subtotal) -> Column:
    return F.round(col_of(subtotal) * F.lit(S.TAX_RATE).cast("decimal(4,2)"), 2).cast("decimal(12,2)")


def order_shipping(subtotal) -> Column:
    return F.when(col_of(subtotal) > F.lit(S.FREE_SHIPPING_OVER).cast("decimal(12,2)"),
                  F.lit("0").cast("decimal(10,2)")).otherwise(F.lit(S.SHIPPING_FEE).cast("decimal(10,2)"))


def order_total(subtotal, tax, shipping, discount) -> Column:
    return (col_of(subtotal) + col_of(tax) + col_of(shipping) - col_of(discount)).cast("decimal(12,2)")


def full_name(first="first_name", last="last_name") -> Column:
    return F.concat_ws(" ", col_of(first), col_of(last))


def age_years(dob, as_of) -> Column:
    return F.floor(F.months_between(F.lit(str(as_of)).cast("date"), col_of(dob)) / 12).cast("int")


def days_between(earlier, as_of) -> Column:
    ref = F.lit(str(as_of)).cast("date") if not isinstance(as_of, Column) else as_of
    return F.datediff(ref, col_of(earlier))


def duration_seconds(start, end) -> Column:
    return F.timestamp_diff("SECOND", col_of(start), col_of(end)).cast("int")


def pct(numer, denom, scale: int = 2) -> Column:
    """``ROUND(numer / NULLIF(denom, 0) * 100, scale)`` for counts, rounded
    half-up. Written as floor((2*100*10^s*n + d) / (2d)) / 10^s in doubles,
    which is exact for counts below 2^53 / 10^(s+2) and reproducible in any
    engine with IEEE doubles."""
    f = float(10 ** scale)
    n = col_of(numer).cast("double")
    d = col_of(denom).cast("double")
    return F.when(d != 0, F.floor((n * (200.0 * f) + d) / (d * 2.0)) / f)


def money_avg(total, count) -> Column:
    """``ROUND(total / count, 2)`` for a money total (2 dp) and a count, half-up,
    via integer cents."""
    cents = (col_of(total) * 100).cast("long").cast("double")
    n = col_of(count).cast("double")
    return F.when(n != 0, F.floor((cents * 2.0 + n) / (n * 2.0)) / 100.0)


def quality_rate(valid, total, empty_value: float = 100.0) -> Column:
    """valid / total x 100 with one decimal, or ``empty_value`` on no input."""
    return F.when(col_of(total) > 0, pct(valid, total, 1)).otherwise(F.lit(empty_value))
