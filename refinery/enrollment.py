"""The enrollment curation job: its data model as a spec for :mod:`refinery.curation`."""

from __future__ import annotations

import os
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

from . import curation
from .curation import Lookup, Spec
from .functions.text import Field, standardize
from .sources import landing, raw

# Enrollment columns, allowed statuses, required fields, rule names in order.
ENR_COLS = ["enrollment_id", "member_id", "plan_id", "coverage_year", "effective_date",
            "termination_date", "status", "monthly_premium"]
VALID_STATUSES = ["PENDING", "ACTIVE", "TERMINATED", "CANCELLED"]
REQUIRED = ["enrollment_id", "member_id", "plan_id", "effective_date", "status", "monthly_premium"]
MEMBER_COLS = ["member_id", "application_id", "state_code", "age_band", "household_size"]
PLAN_COLS = ["plan_id", "issuer_id", "plan_name", "metal_level", "coverage_year", "active_flag"]
ISSUER_COLS = ["issuer_id", "issuer_name", "state_code", "active_flag"]
# Default raw-zone layout: system of record ("operational"), plan reference system
# ("planref") and the partner feed ("external").
RAW_LAYOUT = {"enrollments": "operational/enrollments", "feed": "external/enrollment_feed",
              "members": "operational/members", "plans": "planref/plans", "issuers": "planref/issuers"}
REASONS = ["MISSING_REQUIRED_FIELD", "INVALID_MEMBER_ID", "INVALID_PLAN_ID", "NEGATIVE_PREMIUM",
           "INVALID_STATUS", "INVALID_DATE_RANGE", "DUPLICATE_ENROLLMENT"]

FAILS = [" OR ".join(f"{c} IS NULL" for c in REQUIRED), "NOT known_member", "NOT known_plan", "monthly_premium < 0",
         f"status NOT IN ({', '.join(repr(s) for s in VALID_STATUSES)})", "termination_date < effective_date"]
PLAN_ISSUER = Lookup("issuers", "issuer_id", {"issuer_name": "issuer_name", "issuer_state": "state_code"})
SPEC = Spec(
    fields=[Field("enrollment_id", "bigint"), Field("member_id", "bigint"), Field("plan_id"),
            Field("coverage_year", "int"), Field("effective_date", "date"), Field("termination_date", "date"),
            Field("status", upper=True), Field("monthly_premium", "decimal(10,2)")],
    key=["enrollment_id"],
    references={"known_member": ("members", "member_id"), "known_plan": ("plans", "plan_id")},
    rules=list(zip(REASONS, FAILS)),
    duplicate_reason=REASONS[-1],
    lookups=[Lookup("plans", "plan_id", {c: c for c in ("plan_name", "metal_level", "issuer_id", "issuer_name")}),
             Lookup("members", "member_id", {"member_state": "member_state", "age_band": "age_band"})],
    derived={"active_indicator": "status = 'ACTIVE'"})

# table → (raw columns, fields)
REFERENCE_TABLES = {
    "members": (MEMBER_COLS, [Field("member_id", "bigint"), Field("member_state", source="state_code"),
                              Field("age_band"), Field("household_size", "int")]),
    "plans": (PLAN_COLS, [Field("plan_id"), Field("issuer_id"), Field("plan_name"), Field("metal_level")]),
    "issuers": (ISSUER_COLS, [Field("issuer_id"), Field("issuer_name"), Field("state_code")]),
}


def reference_tables(spark: SparkSession, raw_root: str, layout: Mapping[str, str]) -> dict[str, DataFrame]:
    """Newest batches of members, plans (with their issuer's attributes) and issuers, standardized."""
    tables = {name: standardize(raw.read_latest(spark, os.path.join(raw_root, layout[name]), cols), fields)
              for name, (cols, fields) in REFERENCE_TABLES.items()}
    return tables | {"plans": curation.enriched(tables["plans"], tables, [PLAN_ISSUER])}


def curate_enrollments(spark: SparkSession, raw_root: str, out_root: str, ingestion_ts: str,
                       layout: Mapping[str, str] | None = None, expected_rows: int | None = None) -> dict:
    """Run the curation job; returns the reconciled counts. Beside what
    :func:`refinery.curation.run` writes for ``enrollment``, the reference
    tables go to ``curated/plans`` and ``curated/members``. Enrollments come
    from the system of record (``source_system`` = ``operational``) and the
    partner feed (``external_feed``)."""
    lay = {**RAW_LAYOUT, **(layout or {})}
    tables = reference_tables(spark, raw_root, lay)
    counts = curation.run(spark, raw_root, out_root, "enrollment",
                          {"operational": lay["enrollments"], "external_feed": lay["feed"]}, tables, SPEC,
                          ingestion_ts, expected_rows)
    for name in ("plans", "members"):
        landing.write_curated(tables[name], os.path.join(out_root, "curated", name))
    return counts
