"""Synthetic enrollment-system data as a Spark job (reference tables, households,
members, eligibility, enrollments).

Randomness is a hash of (entity id, seed, purpose), so every value depends
only on its row — not on partitioning or task order — and a rerun with the
same seed reproduces the same data. Sequential ids come from the dense key
assigner, never from a single-partition window.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.operators.star import assign_keys

# Reference data of the enrollment system (issuers, metal levels per
# issuer, base rates, age-band factors, issuer factors, counties, income bands).
COVERAGE_YEAR = 2026
ISSUERS = [
    ("10001", "Harbor Point Health", "TX"),
    ("10002", "Cedar Valley Health", "FL"),
    ("10003", "Summit Ridge Health", "GA"),
    ("10004", "Riverbend Health", "NC"),
]
PLAN_METALS = {
    "10001": ["Bronze", "Silver"],
    "10002": ["Silver", "Gold"],
    "10003": ["Bronze", "Gold"],
    "10004": ["Silver", "Platinum"],
}
BASE_RATE = {"Bronze": "380.00", "Silver": "470.00", "Gold": "560.00", "Platinum": "660.00"}
AGE_FACTOR = {"0-20": "0.65", "21-34": "0.90", "35-49": "1.15", "50-64": "1.75", "65+": "2.00"}
ISSUER_FACTOR = ["1.00", "1.04", "0.97", "1.08"]
COUNTY_CODES = ["001", "003", "005", "007"]
INCOME_BANDS = ["Under 138% FPL", "138-250% FPL", "250-400% FPL", "Over 400% FPL"]

# Generator weights and choices.
HOUSEHOLD_SIZES = [1, 1, 2, 2, 3, 4]
APP_STATUS_WEIGHTS = [("APPROVED", 88), ("IN_REVIEW", 5), ("SUBMITTED", 4), ("DENIED", 3)]
AGE_WEIGHTS = [("0-20", 20), ("21-34", 25), ("35-49", 25), ("50-64", 27), ("65+", 3)]
ENROLLMENT_STATUS_WEIGHTS = [("ACTIVE", 88), ("PENDING", 4), ("CANCELLED", 4), ("TERMINATED", 4)]
ELIGIBILITY_BY_APP_STATUS = {"APPROVED": "ELIGIBLE", "DENIED": "INELIGIBLE"}


def _u(id_col: Column, seed: int, tag: str, modulus: int) -> Column:
    """Deterministic draw in [0, modulus) for a row and purpose."""
    return F.pmod(F.xxhash64(id_col, F.lit(seed), F.lit(tag)), F.lit(modulus))


def weighted_choice(id_col: Column, seed: int, tag: str, choices: list[tuple[str, int]]) -> Column:
    """Pick a label with the given integer weights (cumulative buckets of a hash draw)."""
    total = sum(w for _, w in choices)
    u = _u(id_col, seed, tag, total)
    out, acc = None, 0
    for label, w in choices[:-1]:
        acc += w
        out = F.when(u < acc, F.lit(label)) if out is None else out.when(u < acc, F.lit(label))
    return out.otherwise(F.lit(choices[-1][0])) if out is not None else F.lit(choices[-1][0])


def uniform_choice(id_col: Column, seed: int, tag: str, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (_u(id_col, seed, tag, len(values)) + 1).cast("int"))


@dataclass
class ReferenceData:
    issuers: DataFrame
    plans: DataFrame
    rates: DataFrame
    service_areas: DataFrame


def reference_tables(spark: SparkSession, seed: int = 42) -> ReferenceData:
    """Issuers, plans (two per issuer), rates (plan × age band) and service areas (two counties per plan)."""
    rows = [(i + 1, iid, name, st, PLAN_METALS[iid], Decimal(ISSUER_FACTOR[i])) for i, (iid, name, st) in enumerate(ISSUERS)]
    iss = spark.createDataFrame(rows, "idx int, issuer_id string, issuer_name string, state_code string, "
                                      "metals array<string>, issuer_factor decimal(3,2)")
    issuers = iss.select("issuer_id", "issuer_name", "state_code", F.lit(True).alias("active_flag"))
    base = F.create_map(*[x for m, r in BASE_RATE.items() for x in (F.lit(m), F.lit(Decimal(r)))])
    plans_x = (iss.select("*", F.posexplode("metals").alias("pos", "metal_level"))
               .withColumn("n", F.col("pos") + 1)
               .withColumn("plan_id", F.format_string("%s%s%03d0001", "issuer_id", "state_code", "n"))
               .withColumn("plan_name", F.concat_ws(" ", F.regexp_replace("issuer_name", " [^ ]+$", ""),
                                                    F.col("metal_level"),
                                                    F.when(F.col("n") == 1, "HMO").otherwise("PPO")))
               .withColumn("base_rate", F.element_at(base, F.col("metal_level"))))
    plans = plans_x.select("plan_id", "issuer_id", "plan_name", "metal_level",
                           F.lit(COVERAGE_YEAR).cast("short").alias("coverage_year"),
                           F.lit(True).alias("active_flag"))
    ages = F.array(*[F.struct(F.lit(b).alias("age_band"), F.lit(Decimal(f)).alias("age_factor"))
                     for b, f in AGE_FACTOR.items()])
    rates_x = plans_x.select("idx", "n", "plan_id", "base_rate", "issuer_factor",
                             F.posexplode(ages).alias("apos", "a"))
    rates = rates_x.select(
        ((F.col("idx") - 1) * 10 + (F.col("n") - 1) * 5 + F.col("apos") + 1).cast("int").alias("rate_id"),
        "plan_id", F.col("a.age_band").alias("age_band"),
        F.round(F.col("base_rate") * F.col("a.age_factor") * F.col("issuer_factor"), 2)
        .cast("decimal(10,2)").alias("monthly_rate"),
        F.lit(COVERAGE_YEAR).cast("short").alias("coverage_year"))
    counties = F.array(*[F.struct(_u(F.concat(F.col("plan_id"), F.lit(c)), seed, "county", 1 << 30).alias("h"),
                                  F.lit(c).alias("county_code")) for c in COUNTY_CODES])
    areas = (plans_x.select("idx", "n", "plan_id", "state_code",
                            F.posexplode(F.slice(F.array_sort(counties), 1, 2)).alias("cpos", "c"))
             .select(((F.col("idx") - 1) * 4 + (F.col("n") - 1) * 2 + F.col("cpos") + 1).cast("int")
                     .alias("service_area_id"), "plan_id", "state_code", F.col("c.county_code").alias("county_code")))
    return ReferenceData(issuers, plans, rates, areas)


@dataclass
class SourceData:
    applications: DataFrame
    members: DataFrame
    eligibility: DataFrame
    enrollments: DataFrame


def source_tables(spark: SparkSession, ref: ReferenceData, members: int = 2000, enrollments: int = 3000,
                  seed: int = 42) -> SourceData:
    """Applications → households → members (+ one eligibility row each) → enrollments.

    Only ELIGIBLE members enroll; ``enrollments − eligible`` of them switch
    plan mid-year (a TERMINATED row ending the day before an ACTIVE row, both
    in the member's state); others get one row (CANCELLED ends on its start,
    TERMINATED at a month end). Premium = rate(plan, age band).
    """
    states = [s for _, _, s in ISSUERS]
    n_apps = int(members / (sum(HOUSEHOLD_SIZES) / len(HOUSEHOLD_SIZES)) * 1.2) + 10
    apps = (spark.range(1, n_apps + 1).withColumnRenamed("id", "app_seq")
            .withColumn("state_code", uniform_choice(F.col("app_seq"), seed, "state", states))
            .withColumn("household", uniform_choice(F.col("app_seq"), seed, "household", HOUSEHOLD_SIZES))
            .withColumn("application_status", weighted_choice(F.col("app_seq"), seed, "app_status",
                                                              APP_STATUS_WEIGHTS))
            .withColumn("submitted_date", F.date_add(F.lit("2025-11-01").cast("date"),
                                                     _u(F.col("app_seq"), seed, "submitted", 76).cast("int"))))
    people = apps.select("*", F.explode(F.sequence(F.lit(1), F.col("household"))).alias("member_seq"))
    people = assign_keys(people, ["app_seq", "member_seq"], "member_no").filter(F.col("member_no") <= members)
    elig_map = F.create_map(*[x for k, v in ELIGIBILITY_BY_APP_STATUS.items() for x in (F.lit(k), F.lit(v))])
    people = (people
              .withColumn("application_id", F.col("app_seq") + 500000)
              .withColumn("member_id", F.col("member_no") + 100000)
              .withColumn("age_band", weighted_choice(F.col("member_id"), seed, "age", AGE_WEIGHTS))
              .withColumn("household_size", F.least(F.col("household"), F.lit(members) - F.col("member_no")
                                                    + F.col("member_seq")).cast("short"))
              .withColumn("eligibility_status",
                          F.coalesce(F.element_at(elig_map, F.col("application_status")), F.lit("PENDING"))))
    kept_apps = people.select("application_id").distinct()
    applications = (apps.withColumn("application_id", F.col("app_seq") + 500000)
                    .join(kept_apps, "application_id", "left_semi")
                    .select("application_id", F.lit(COVERAGE_YEAR).cast("short").alias("coverage_year"),
                            "state_code", "application_status", "submitted_date"))
    member_df = people.select("member_id", "application_id", "state_code", "age_band", "household_size")
    eligibility = people.select((F.col("member_no") + 700000).alias("eligibility_id"), "member_id",
                                "eligibility_status",
                                F.make_date(F.lit(COVERAGE_YEAR), F.lit(1), F.lit(1)).alias("effective_date"),
                                uniform_choice(F.col("member_id"), seed, "income", INCOME_BANDS).alias("income_band"))

    eligible = people.filter(F.col("eligibility_status") == "ELIGIBLE")
    n_eligible = eligible.count()
    switch_count = enrollments - n_eligible
    if not 0 <= switch_count <= n_eligible:
        raise ValueError(f"cannot reach {enrollments} enrollments from {n_eligible} eligible members")
    ranked = assign_keys(eligible.withColumn("__h", F.xxhash64(F.col("member_id"), F.lit(seed), F.lit("switch"))),
                         ["__h", "member_id"], "__switch_rank")
    state_plans = (ref.plans.withColumn("state_code", F.substring("plan_id", 6, 2))   # state from the plan id
                   .groupBy("state_code")
                   .agg(F.array_sort(F.collect_list("plan_id")).alias("state_plans")))   # two plans per state
    m = ranked.join(state_plans, "state_code").withColumn("switcher", F.col("__switch_rank") <= switch_count)
    pick = _u(F.col("member_id"), seed, "plan", 2) + 1
    other = 3 - pick
    month = F.when(_u(F.col("member_id"), seed, "special", 10) < 8, F.lit(1)) \
        .otherwise(_u(F.col("member_id"), seed, "month", 8) + 2)
    status = weighted_choice(F.col("member_id"), seed, "enr_status", ENROLLMENT_STATUS_WEIGHTS)
    switch_date = F.make_date(F.lit(COVERAGE_YEAR), (_u(F.col("member_id"), seed, "switch_month", 7) + 3).cast("int"),
                              F.lit(1))
    eff = F.make_date(F.lit(COVERAGE_YEAR), month.cast("int"), F.lit(1))
    end_month = F.least(month + _u(F.col("member_id"), seed, "term", 3) + 2, F.lit(12)).cast("int")
    single = F.struct(
        F.lit(1).alias("seq"), F.element_at("state_plans", pick.cast("int")).alias("plan_id"), eff.alias("effective_date"),
        F.when(status == "CANCELLED", eff)
        .when(status == "TERMINATED", F.date_sub(F.make_date(F.lit(COVERAGE_YEAR), end_month, F.lit(1)), 1))
        .alias("termination_date"),
        status.alias("status"))
    first = F.struct(F.lit(1).alias("seq"), F.element_at("state_plans", pick.cast("int")).alias("plan_id"),
                     F.make_date(F.lit(COVERAGE_YEAR), F.lit(1), F.lit(1)).alias("effective_date"),
                     F.date_sub(switch_date, 1).alias("termination_date"), F.lit("TERMINATED").alias("status"))
    second = F.struct(F.lit(2).alias("seq"), F.element_at("state_plans", other.cast("int")).alias("plan_id"),
                      switch_date.alias("effective_date"), F.lit(None).cast("date").alias("termination_date"),
                      F.lit("ACTIVE").alias("status"))
    rows = m.select("member_id", "age_band",
                    F.explode(F.when(F.col("switcher"), F.array(first, second)).otherwise(F.array(single))).alias("e"))
    rows = rows.select("member_id", "age_band", "e.*")
    rates = ref.rates.select("plan_id", "age_band", "monthly_rate")
    rows = rows.join(F.broadcast(rates), ["plan_id", "age_band"], "left")   # 40 rows: fixed size
    keyed = assign_keys(rows, ["member_id", "seq"], "enrollment_no")
    enroll = keyed.select((F.col("enrollment_no") + 900000).alias("enrollment_id"), "member_id", "plan_id",
                          F.lit(COVERAGE_YEAR).cast("short").alias("coverage_year"), "effective_date",
                          "termination_date", "status", F.col("monthly_rate").alias("monthly_premium"))
    return SourceData(applications, member_df, eligibility, enroll)
