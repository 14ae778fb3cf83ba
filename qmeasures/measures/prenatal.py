"""Timeliness of prenatal care and postpartum care (per delivery, summed per member)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from qmeasures.functions.dates import D
from qmeasures.inputs import ClaimsInputs
from qmeasures.operators.binned import latest_window_at, overlapping_pairs
from qmeasures.operators.flagged import FlagRequest
from qmeasures.operators.intervals import anchored_groups, coverage_islands, eligibility_gaps
from qmeasures.operators.reuse import materialize
from qmeasures.params import MeasureParams
from qmeasures.schemas import to_result

MEASURE = "prenatal_postpartum_care"
INTAKE_SHIFT_DAYS = 85
DELIVERY_GROUP_DAYS = 60
CE_BEFORE, CE_AFTER = 43, 60
PRENATAL_LOOKBACK = 280
RECENT_SEGMENT_DAYS = 219
SEGMENT_VISIT_DAYS = 42
PRENATAL_LATE_END = 176
POSTPARTUM_START, POSTPARTUM_END = 7, 84
# the published +-10 day test around the delivery is joined by OR, so it always holds
# (any non-live-birth claim excludes); no constant is needed for it
# components handled outside the generic flag loop (lookup list / no claim codes)
SKIPPED_COMPONENTS = ("pregnancy_diagnosis", "cervical_cytology_result")


def intake_period(p: MeasureParams):
    start = p.measure_start - dt.timedelta(days=INTAKE_SHIFT_DAYS)
    try:
        next_year = start.replace(year=start.year + 1)
    except ValueError:
        next_year = start.replace(year=start.year + 1, day=28)
    return start, next_year - dt.timedelta(days=1)


def requests(inp: ClaimsInputs) -> list[FlagRequest]:
    """Claim line flags of the measure; the pregnancy list must be ICD-10 diagnoses throughout."""
    comps = [x for x, _ in inp.component_list(MEASURE, exclude=SKIPPED_COMPONENTS)]
    return [*(inp.request("hedis", MEASURE, x) for x in comps),
            inp.request("hedis", MEASURE, "pregnancy_diagnosis", versioned=True, only=("ICD10CM-Diag",))]


def _as_numbers(lines: DataFrame, wanted: list[FlagRequest]) -> DataFrame:
    return lines.select("member_id", "prm_fromdate", "prm_todate",
                        *[F.col(f"`{r.name}`").cast("int").alias(r.component) for r in wanted])


def delivery_dates(flags: DataFrame, p: MeasureParams) -> DataFrame:
    """member_id, delivery_id, delivery_date from anchored grouping of delivery lines."""
    lo, hi = intake_period(p)
    deliveries = (flags.filter((F.col("deliveries") == 1) & F.col("prm_todate").between(D(lo), D(hi)))
                  .select("member_id", "prm_fromdate", "prm_todate").distinct())
    # every group takes at least DELIVERY_GROUP_DAYS + 1 days of the intake period
    most = (hi - lo).days // (DELIVERY_GROUP_DAYS + 1) + 1
    grouped = anchored_groups(deliveries, "member_id", ["prm_fromdate", "prm_todate"], "prm_todate",
                              DELIVERY_GROUP_DAYS, group_col="delivery_id", max_groups=most)
    return grouped.groupBy("member_id", "delivery_id").agg(F.max("prm_todate").alias("delivery_date"))


def enrollment_segments(spans: DataFrame, keys=("member_id", "delivery_date")) -> DataFrame:
    """Contiguous covered segments per key group: a new segment unless start = previous end + 1.

    Same rule as coverage islands without clipping, so it runs on the counted
    distinct-span form (bounded per member); ids are 0-based.
    """
    isl = coverage_islands(spans, list(keys), None, None)
    return isl.select(*keys, (F.col("island_id") - 1).cast("long").alias("enrollment_segment_id"),
                      F.col("island_start").alias("enrollment_segment_start"),
                      F.col("island_end").alias("enrollment_segment_end"))


def relevant_lines(inp: ClaimsInputs) -> DataFrame:
    """Written claim lines that carry a delivery, visit, non-live-birth or hospice flag."""
    wanted = requests(inp)
    relevant = ("deliveries", "non_live_births", "hospice_encounter", "hospice_intervention", "prenatal_bundled",
                "standalone_prenatal", "prenatal_visits", "postpartum_visits", "cervical_cytology_lab", "postpartum_bundled")
    # on the flags before they are numbers: a filter on what the projection makes doubles its constraints with each flag
    names = {r.component: r.name for r in wanted}
    some = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"`{names[c]}`"), F.lit(False)) for c in relevant])
    return materialize(_as_numbers(inp.flagged_lines(wanted).filter(some), wanted))


def delivery_spans(inp: ClaimsInputs, deliveries: DataFrame) -> DataFrame:
    covered = inp.member_time.filter(F.col("cover_medical") == "Y").select("member_id", "date_start", "date_end")
    return deliveries.select("member_id", "delivery_date").join(covered, "member_id")


def delivery_windows(inp: ClaimsInputs, p: MeasureParams, deliveries: DataFrame) -> DataFrame:
    """Per delivery: gap count on [d-43, d+60] and the prenatal / postpartum windows."""
    d = deliveries.select("member_id", "delivery_date",
                          F.date_sub("delivery_date", CE_BEFORE).alias("ce_start_date"),
                          F.date_add("delivery_date", CE_AFTER).alias("ce_end_date"))
    covered = (inp.member_time.filter(F.col("cover_medical") == "Y").select("member_id", "date_start", "date_end")
               .join(d.select("member_id").distinct(), "member_id", "left_semi"))
    keys = ["member_id", "delivery_date"]
    # only spans that reach into a delivery's window; a delivery without any keeps its row
    inside = overlapping_pairs(d, covered, "member_id", ("ce_start_date", "ce_end_date"), ("date_start", "date_end"))
    gaps = eligibility_gaps(inside.unionByName(d, allowMissingColumns=True), keys, "ce_start_date", "ce_end_date")
    # a member's segments do not depend on the delivery: found once, then looked up by day
    segments = (enrollment_segments(covered, ["member_id"])
                .withColumn("_until", F.date_add("enrollment_segment_end", PRENATAL_LOOKBACK)))
    last = (latest_window_at(d, segments, "member_id", "delivery_date", "enrollment_segment_start", "_until")
            .join(gaps, keys))
    recent = F.datediff("delivery_date", "enrollment_segment_start") <= RECENT_SEGMENT_DAYS
    return last.select(
        *keys, "gap_cnt", "enrollment_segment_start",
        F.when(recent, F.col("enrollment_segment_start"))
        .otherwise(F.date_sub("delivery_date", PRENATAL_LOOKBACK)).alias("prenatal_care_start_date"),
        F.when(recent, F.date_add("enrollment_segment_start", SEGMENT_VISIT_DAYS))
        .otherwise(F.date_sub("delivery_date", PRENATAL_LATE_END)).alias("prenatal_care_end_date"),
        F.date_add("delivery_date", POSTPARTUM_START).alias("postpartum_care_start_date"),
        F.date_add("delivery_date", POSTPARTUM_END).alias("postpartum_care_end_date"))


def _on(c):
    return F.coalesce(F.col(c) != 0, F.lit(False))


def prenatal_postpartum_long(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """member_id, measure, denominator, numerator (before dropping denominator 0)."""
    # only lines carrying one of these flags matter; they are read by three branches
    flags = relevant_lines(inp)
    windows = materialize(delivery_windows(inp, p, delivery_dates(flags, p)))
    # member-level flags: any non-live birth line (the +-10 day test is always true) and
    # any hospice line, at any date
    member_flags = (flags.filter(_on("non_live_births") | _on("hospice_encounter") | _on("hospice_intervention"))
                    .groupBy("member_id")
                    .agg(F.max(_on("non_live_births").cast("int")).alias("denom_non_live_births"),
                         F.max((_on("hospice_encounter") | _on("hospice_intervention")).cast("int")).alias("hospice")))
    prenatal_visit = _on("prenatal_bundled") | _on("standalone_prenatal") | (_on("prenatal_visits") & _on("pregnancy_diagnosis"))
    postpartum_visit = ((_on("postpartum_visits") | _on("cervical_cytology_lab") | _on("postpartum_bundled"))
                        & ~(_on("acute_inpatient") | _on("acute_inpatient_pos")))
    # one row per member and day before the join with the deliveries: bounded by the calendar
    visits = (flags.filter(prenatal_visit | postpartum_visit).groupBy("member_id", "prm_todate")
              .agg(F.max(prenatal_visit).alias("_pre"), F.max(postpartum_visit).alias("_post")))
    timed = (visits.join(windows.select("member_id", "delivery_date", "prenatal_care_start_date",
                                        "prenatal_care_end_date", "postpartum_care_start_date",
                                        "postpartum_care_end_date"), "member_id")
             .groupBy("member_id", "delivery_date")
             .agg(F.max((F.col("_pre") & F.col("prm_todate").between(F.col("prenatal_care_start_date"),
                                                                    F.col("prenatal_care_end_date"))).cast("int"))
                  .alias("numerator_prenatal_visit"),
                  F.max((F.col("_post") & F.col("prm_todate").between(F.col("postpartum_care_start_date"),
                                                                     F.col("postpartum_care_end_date"))).cast("int"))
                  .alias("numerator_postpartum_visit")))
    res = (windows.join(timed, ["member_id", "delivery_date"], "left").join(member_flags, "member_id", "left"))
    denominator = F.when(_on("denom_non_live_births") | _on("gap_cnt") | _on("hospice"), 0).otherwise(1)
    both = res.select("member_id", denominator.alias("denominator"),
                      F.explode(F.array(
                          F.struct(F.lit("prenatal_care").alias("measure"),
                                   F.coalesce("numerator_prenatal_visit", F.lit(0)).alias("numerator")),
                          F.struct(F.lit("postpartum_care").alias("measure"),
                                   F.coalesce("numerator_postpartum_visit", F.lit(0)).alias("numerator")))).alias("_m"))
    return (both.groupBy("member_id", F.col("_m.measure").alias("measure"))
            .agg(F.sum("denominator").alias("denominator"), F.sum("_m.numerator").alias("numerator")))


def _published(inp, p, measure):
    long = inp.memo(("prenatal_long", p.key()), lambda: materialize(prenatal_postpartum_long(inp, p)))
    return to_result(long.filter((F.col("measure") == measure) & (F.col("denominator") != 0)))


def prenatal_care(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    return _published(inp, p, "prenatal_care")


def postpartum_care(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    return _published(inp, p, "postpartum_care")
