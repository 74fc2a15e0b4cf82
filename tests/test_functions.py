"""Validator, enrichment and title-case edge cases."""

from pyspark.sql import functions as F

from shoptrail.functions.events import (business_value_score, event_category, issue_tags, page_title,
                                        pct, python_title, quality_band)
from shoptrail.operators.validate import with_validity

NOW = "2024-01-31 00:00:00"
COLS = "customer_id string, event_type string, amount string, currency string, event_timestamp string, is_valid boolean"


def _valid(spark, rows, **kw):
    df = spark.createDataFrame(rows, COLS)
    return [r["is_valid_event"] for r in with_validity(df, as_of=NOW, **kw).collect()]


def test_validator_rules(spark):
    rows = [
        ("CUST_1", "PAGE_VIEW", None, None, "2024-01-10T10:00:00", True),          # ok, no money needed
        ("CUST_1", "PAGE_VIEW", "-5", None, "2024-01-10T10:00:00", True),          # negative amount ok off money
        ("", "PAGE_VIEW", None, None, "2024-01-10T10:00:00", True),                # empty customer
        (None, "PAGE_VIEW", None, None, "2024-01-10T10:00:00", True),              # null customer
        ("CUST_1", "CLICK", None, None, "2024-01-10T10:00:00", True),              # unknown type
        ("CUST_1", "REMOVE_FROM_CART", None, None, "2024-01-10T10:00:00", True),   # not in validator list
        ("CUST_1", "PURCHASE", "12.50", "USD", "2024-01-10T10:00:00", True),       # money ok
        ("CUST_1", "PURCHASE", "0", "USD", "2024-01-10T10:00:00", True),           # zero amount
        ("CUST_1", "PURCHASE", "abc", "USD", "2024-01-10T10:00:00", True),         # text amount
        ("CUST_1", "ADD_TO_CART", "5", None, "2024-01-10T10:00:00", True),         # no currency
        ("CUST_1", "ADD_TO_CART", "5", "", "2024-01-10T10:00:00", True),           # empty currency
        ("CUST_1", "PAGE_VIEW", None, None, None, True),                           # null time
        ("CUST_1", "PAGE_VIEW", None, None, "not a time", True),                   # bad time
        ("CUST_1", "PAGE_VIEW", None, None, "2024-01-31T00:59:00", True),          # within 1 h ahead
        ("CUST_1", "PAGE_VIEW", None, None, "2024-01-31T01:01:00", True),          # beyond 1 h ahead
        ("CUST_1", "PAGE_VIEW", None, None, "2024-01-10T10:00:00Z", True),         # zone: accepted (UTC)
        ("CUST_1", "PAGE_VIEW", None, None, "2024-01-31T02:30:00+02:00", True),    # 00:30 UTC: ok
        ("CUST_1", "PAGE_VIEW", None, None, "2024-01-10T10:00:00", None),          # null declared
        ("CUST_1", "PAGE_VIEW", None, None, "2024-01-10T10:00:00", False),         # declared invalid
    ]
    assert _valid(spark, rows) == [True, True, False, False, False, False, True, False, False, False, False,
                                   False, False, True, False, True, True, False, False]


def test_validator_strict_zone(spark):
    rows = [("CUST_1", "PAGE_VIEW", None, None, "2024-01-10T10:00:00Z", True),
            ("CUST_1", "PAGE_VIEW", None, None, "2024-01-10T10:00:00", True)]
    assert _valid(spark, rows, strict=True) == [False, True]


def test_category_and_score(spark):
    types = ["PAGE_VIEW", "SEARCH", "PRODUCT_VIEW", "ADD_TO_CART", "PURCHASE", "REVIEW", "SHARE"]
    df = spark.createDataFrame([(t,) for t in types], "event_type string")
    out = df.select(event_category().alias("c"), business_value_score().alias("s")).collect()
    assert [r.c for r in out] == ["engagement", "engagement", "consideration", "consideration",
                                  "conversion", "retention", None]
    assert [r.s for r in out] == [1, 2, 3, 7, 10, 5, 0]


def test_python_title_matches_str_title(spark):
    samples = ["gift-cards", "new-arrivals", "product_12abc", "ÉTÉ-sale", "a1b2 c3", "", "x--y"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(python_title("s")).collect()]
    assert got == [s.title() for s in samples]


def test_page_title_lookup_and_fallback(spark):
    df = spark.createDataFrame([("/",), ("/new-arrivals",), ("/gift-cards",)], "page_url string")
    got = [r[0] for r in df.select(page_title()).collect()]
    assert got == ["Home - E-commerce Store", "New Arrivals - E-commerce Store", "Gift-Cards - E-commerce Store"]


def test_issue_tags(spark):
    df = spark.createDataFrame(
        [(None, "S1", "2024-01-10 00:00:00", "abc", -1.0), ("C1", None, "2024-03-01 00:00:00", "5", 2.0),
         ("C1", "S1", "2024-01-10 00:00:00", "5", 2.0)],
        "customer_id string, session_id string, timestamp string, amount string, product_price double")
    got = [r[0] for r in df.select(issue_tags(event_time=F.col("timestamp").cast("timestamp_ntz"),
                                              as_of=NOW)).collect()]
    assert got == [["missing_customer_id", "invalid_amount_format", "negative_price"],
                   ["missing_session_id", "future_timestamp"], []]


def test_pct_half_up_and_bands(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (0, 0), (2, 3)], "n long, d long")
    got = [r[0] for r in df.select(pct("n", "d")).collect()]
    assert got == [12.5, 33.33, None, 66.67]
    b = spark.createDataFrame([(95.0,), (70.0,), (69.9,)], "s double").select(quality_band("s")).collect()
    assert [r[0] for r in b] == ["excellent", "good", "poor"]
