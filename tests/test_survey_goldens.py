"""Golden results recorded for the analytic tables at sf0.01, checked on our Spark plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

from .conftest import SF_MID

Q = entry.queries()


def _rows(spark, name):
    return Q[name](spark, SF_MID).collect()


def test_dq_classification(spark):
    by = {r.rejection_reason: r.rejected_count for r in _rows(spark, "dq_rejections_by_reason")}
    assert by == {"MISSING_REQUIRED_FIELD": 1150, "INVALID_SUPPLIER_ID": 3420, "INVALID_PART_ID": 2607,
                  "NEGATIVE_PREMIUM": 273, "INVALID_STATUS": 1579, "INVALID_DATE_RANGE": 7355,
                  "DUPLICATE_LINEITEM": 11421}
    assert _rows(spark, "dq_summary")[0].accepted == 32195


def test_cdc_goldens(spark):
    net = {}
    for r in _rows(spark, "cdc_net"):
        net[r.net_operation] = net.get(r.net_operation, 0) + 1
    assert net == {"INSERT": 33, "UPDATE": 93, "DELETE": 17}
    assert len(_rows(spark, "cdc_apply")) == 127
    all_rows, with_old = len(_rows(spark, "cdc_all")), len(_rows(spark, "cdc_all_update_old"))
    assert with_old - all_rows == 378


def test_history_goldens(spark):
    hist = Q["scd2_history"](spark, SF_MID)
    assert hist.count() == 8016
    assert hist.filter(F.year("valid_to") == 9999).count() == 150
    assert len(_rows(spark, "as_of")) == 150
    per_type = {r.version_event_type: r.n for r in
                Q["as_of_join_just_before"](spark, SF_MID).groupBy("version_event_type").agg(F.count("*").alias("n")).collect()}
    assert per_type == {"click": 374, "error": 388, "purchase": 402, "signup": 401, "view": 387}


def test_analysis_goldens(spark):
    assert len(_rows(spark, "q3_having")) == 11
    assert {r.price_tier: r.orders for r in _rows(spark, "q4_tiers")} == \
        {"small": 990, "medium": 1971, "large": 1972}
    assert len(_rows(spark, "q5_histogram")) == 22
    assert sum(r.customers_without_events for r in _rows(spark, "q2_no_activity")) == 1350


def test_injected_faults_are_classified_as_labelled(spark):
    rows = _rows(spark, "fault_injection")
    assert rows and all(r.outcome == ("ACCEPTED" if r.expected_reason == "NONE" else r.expected_reason)
                        for r in rows)
    assert {r.expected_reason for r in rows} >= {"MISSING_REQUIRED_FIELD", "INVALID_SUPPLIER_ID", "INVALID_PART_ID",
                                                  "NEGATIVE_PREMIUM", "INVALID_STATUS", "INVALID_DATE_RANGE",
                                                  "DUPLICATE_LINEITEM"}
