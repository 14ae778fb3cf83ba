"""Derive the claims data model from the driver's TPC-H-style tables.

Every column is a deterministic expression of the source rows, so the same model
can be rebuilt in any SQL engine.  The mapping:

* member       customer: ``member_id = 'M' || custkey div 5``; dob from the member number
* member_time  one span per order: first of the order month .. end of month + 2
               (``cover_medical = 'N'`` for status P)
* member_months  every month start of every span (memmos 1)
* outclaims    lineitem x orders (claim = order, dates from the order date); staged once as `lines`
* outpharmacy  line number 4 of every order
* inpdental    lines with ``partkey % 10 < 3``
* providers    supplier (taxonomy ``'TX' || nationkey % 12``)
* foster_care  urgent orders (report date = order date)
* predictions  customers with a positive balance (prob = balance / 10000)

Dates: performance year 1998, latest paid 1998-10-31 (:data:`DRIVER_PARAMS`).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qmeasures.inputs import ClaimsInputs, Later
from qmeasures.params import MeasureParams
from qmeasures.schemas import CODE_TABLE_SCHEMA
from qmeasures.sources.mappings import default_components

DRIVER_PARAMS = MeasureParams(measure_start=dt.date(1998, 1, 1), date_latestpaid=dt.date(1998, 10, 31))
CODE_COLUMNS = 15  # diagnoses and procedures of a claim line
DOB_ANCHOR = dt.date(1998, 12, 31)
ALLOWED_TAXONOMY = [f"TX{i}" for i in range(10)]

# Synthetic code table over the adapter's code space (measure, component, codesystem,
# code, grouping_id, diag_type).  Codes are invented; no licensed list is reproduced.
HEDIS_CODES = [
    ("well_child_visits", "well_care", "CPT", "H1", None, None),
    ("well_child_visits", "well_care", "CPT", "H2", None, None),
    ("well_child_visits", "well_care", "ICD10CM-Diag", "D3", None, None),
    ("well_child_visits", "telehealth_modifier", "Modifier", "95", None, None),
    ("well_child_visits", "telehealth_pos", "POS", "02", None, None),
    ("well_child_visits", "hospice_encounter", "UBREV", "RHSP", None, None),
    ("well_child_visits", "hospice_intervention", "CPT", "HSP", None, None),
    ("diabetes_oral_eval", "acute_inpatient", "CPT", "H30", None, None),
    ("diabetes_oral_eval", "outpatient", "CPT", "H31", None, None),
    ("diabetes_oral_eval", "outpatient", "CPT", "H32", None, None),
    ("diabetes_oral_eval", "observation", "CPT", "H33", None, None),
    ("diabetes_oral_eval", "ed", "UBREV", "R1", None, None),
    ("diabetes_oral_eval", "nonacute_inpatient", "CPT", "H34", None, None),
    ("diabetes_oral_eval", "telehealth_modifier", "MODIFIER", "95", None, None),
    ("diabetes_oral_eval", "telehealth_pos", "POS", "02", None, None),
    ("diabetes_oral_eval", "telephone_visits", "CPT", "H35", None, None),
    ("diabetes_oral_eval", "online_assessments", "CPT", "H36", None, None),
    ("diabetes_oral_eval", "hospice_encounter", "UBREV", "RHSP", None, None),
    ("diabetes_oral_eval", "hospice_intervention", "CPT", "HSP", None, None),
    ("diabetes_oral_eval", "frailty_device", "CPT", "H37", None, None),
    ("diabetes_oral_eval", "frailty_diagnosis", "ICD10CM-Diag", "D8", None, None),
    ("diabetes_oral_eval", "frailty_encounter", "CPT", "H38", None, None),
    ("diabetes_oral_eval", "frailty_symptom", "ICD10CM-Diag", "D9", None, None),
    ("diabetes_oral_eval", "advanced_illness", "ICD10CM-Diag", "D10", None, None),
    ("diabetes_oral_eval", "diabetes", "ICD10CM-Diag", "D11", None, None),
    ("diabetes_oral_eval", "diabetes", "ICD10CM-Diag", "D12", None, None),
    ("diabetes_oral_eval", "diabetes", "ICD9CM-Diag", "D13", None, None),
    ("diabetes_oral_eval", "diabetes_exclusions", "ICD10CM-Diag", "D14", None, None),
    ("prenatal_postpartum_care", "deliveries", "CPT", "H40", None, None),
    ("prenatal_postpartum_care", "deliveries", "ICD10CM-Proc", "P1", None, None),
    ("prenatal_postpartum_care", "non_live_births", "ICD10CM-Proc", "PX", None, None),
    ("prenatal_postpartum_care", "hospice_encounter", "UBREV", "RHSP", None, None),
    ("prenatal_postpartum_care", "hospice_intervention", "CPT", "HSP", None, None),
    ("prenatal_postpartum_care", "prenatal_bundled", "CPT", "H41", None, None),
    ("prenatal_postpartum_care", "standalone_prenatal", "CPT", "H42", None, None),
    ("prenatal_postpartum_care", "prenatal_visits", "CPT", "H43", None, None),
    ("prenatal_postpartum_care", "pregnancy_diagnosis", "ICD10CM-Diag", "D16", None, None),
    ("prenatal_postpartum_care", "pregnancy_diagnosis", "ICD10CM-Diag", "D17", None, None),
    ("prenatal_postpartum_care", "postpartum_visits", "CPT", "H44", None, None),
    ("prenatal_postpartum_care", "cervical_cytology_lab", "CPT", "H45", None, None),
    ("prenatal_postpartum_care", "cervical_cytology_result", "LOINC", "L1", None, None),
    ("prenatal_postpartum_care", "postpartum_bundled", "CPT", "H46", None, None),
    ("prenatal_postpartum_care", "acute_inpatient", "CPT", "H30", None, None),
    ("prenatal_postpartum_care", "acute_inpatient_pos", "POS", "21", None, None),
    ("aod", "alc_abuse_dependence", "ICD10CM-Diag", "D20", None, None),
    ("aod", "alc_abuse_dependence", "ICD10CM-Diag", "D21", None, None),
    *[("aod", "aod_abuse_dependence", "ICD10CM-Diag", f"D{i}", None, None) for i in range(20, 26)],
    ("aod", "opioid_abuse_dependence", "ICD10CM-Diag", "D22", None, None),
    ("aod", "opioid_abuse_dependence", "ICD10CM-Diag", "D23", None, None),
    ("aod", "other_abuse_dependence", "ICD10CM-Diag", "D24", None, None),
    ("aod", "other_abuse_dependence", "ICD10CM-Diag", "D25", None, None),
    ("aod", "aod_med_treatment", "CPT", "H50", None, None),
    ("aod", "detox", "CPT", "H51", None, None),
    ("aod", "ED", "UBREV", "R2", None, None),
    ("aod", "iet_visits_grp_1", "CPT", "H52", None, None),
    ("aod", "iet_pos_grp_1", "POS", "03", None, None),
    ("aod", "iet_visits_grp_2", "CPT", "H53", None, None),
    ("aod", "iet_pos_grp_2", "POS", "05", None, None),
    ("aod", "iet_standalone_visits", "CPT", "H54", None, None),
    ("aod", "iet_standalone_visits", "CPT", "H55", None, None),
    ("aod", "ip_stay", "UBREV", "R3", None, None),
    ("aod", "observation", "CPT", "H33", None, None),
    ("aod", "online_assessments", "CPT", "H36", None, None),
    ("aod", "telephone_visits", "CPT", "H35", None, None),
    ("aod", "hospice_encounter", "UBREV", "RHSP", None, None),
    ("aod", "hospice_intervention", "CPT", "HSP", None, None),
]

MEDICATION_CODES = [
    ("diabetes_oral_eval", "diabetes_medications", "NDC", "00000000007", None, None),
    ("diabetes_oral_eval", "diabetes_medications", "NDC", "00000000008", None, None),
    ("diabetes_oral_eval", "dementia_medications", "NDC", "00000000009", None, None),
    ("aod", "alcohol_treatment_meds", "NDC", "00000000011", None, None),
    ("aod", "opioid_treatment_meds", "NDC", "00000000012", None, None),
]

OHA_CODES = [
    ("ED_Visits", "numer_cpt", "CPT", "H10", None, None),
    ("ED_Visits", "numer_cpt", "CPT", "H11", None, None),
    ("ED_Visits", "numer_rev", "UBREV", "R5", None, None),
    ("ED_Visits", "numer_procs", "CPT", "H12", "G1", None),
    ("ED_Visits", "numer_procs", "POS", "07", "G1", None),
    ("ED_Visits", "numer_procs", "CPT", "H13", "G2", None),
    ("ED_Visits", "numer_procs", "POS", "08", "G2", None),
    ("ED_Visits", "numer_excl_mh", "ICD10CM-Diag", "D7", None, "Primary"),
    ("ED_Visits", "numer_excl_mh", "ICD9CM-Diag", "D6", None, "Primary"),
    ("ED_Visits", "numer_excl_psych", "CPT", "H14", None, None),
    ("ED_Visits", "numer_excl_ip_stay", "UBREV", "R7", None, None),
    ("ED_Visits", "denom_excl_hospice", "CPT", "HSP", None, None),
    ("ED_Visits", "denom_excl_hospice", "UBREV", "RHSP", None, None),
    ("ED_Visits_MI", "Denominator", "ICD10CM-Diag", "D1", None, None),
    ("ED_Visits_MI", "Denominator", "ICD10CM-Diag", "D2", None, None),
    ("ED_Visits_MI", "Denominator", "ICD9CM-Diag", "D5", None, None),
    ("DHS_assessments", "Numerator_Physical", "CPT", "H20", None, None),
    ("DHS_assessments", "Numerator_Physical", "CPT", "H21", None, None),
    ("DHS_assessments", "Numerator_Mental", "CPT", "H22", None, None),
    ("DHS_assessments", "Numerator_Mental", "CPT", "H23", "DHS_Pair1", None),
    ("DHS_assessments", "Numerator_Mental", "MODIFIER", "95", "DHS_Pair1", None),
    ("DHS_assessments", "Numerator_PRTS", "CPT", "H24", "DHS_Pair2", None),
    ("DHS_assessments", "Numerator_PRTS", "POS", "11", "DHS_Pair2", None),
    ("DHS_assessments", "Numerator_Dental", "CDT", "D0120", None, None),
    ("DHS_assessments", "Numerator_Dental", "CDT", "H25", None, None),
    ("DHS_assessments", "Numerator_PhysMent", "CPT", "H21", "physical_mental", None),
    ("DHS_assessments", "Numerator_PhysMent", "ICD9CM-Diag", "D4", "physical_mental", None),
    ("DHS_assessments", "Numerator_PhysMent", "ICD10CM-Diag", "D4", "physical_mental", None),
    ("diabetes_oral_eval", "numerator", "CDT", "D0120", None, None),
    ("dental_services", "diagnostic_dental", "CDT", "D0120", None, None),
    ("dental_services", "diagnostic_dental", "CDT", "D0150", None, None),
    ("dental_services", "preventive_dental", "CDT", "D1110", None, None),
    ("dental_services", "preventive_dental", "CDT", "D1206", None, None),
    ("dental_services", "dental_treatment", "CDT", "D2140", None, None),
]


_CODE_TABLES: dict = {}


def code_table(spark: SparkSession, rows) -> DataFrame:
    """The synthetic code table as a DataFrame (one instance per session and list, so the
    per-measure code slices read on the driver are reused across queries)."""
    key = (spark.sparkContext.applicationId, id(rows))
    for old in [k for k in _CODE_TABLES if k[0] != key[0]]:  # frames of ended sessions
        del _CODE_TABLES[old]
    if key not in _CODE_TABLES:
        _CODE_TABLES[key] = spark.createDataFrame(rows, CODE_TABLE_SCHEMA)
    return _CODE_TABLES[key]


def _components(spark: SparkSession) -> DataFrame:
    key = (spark.sparkContext.applicationId, "components")
    if key not in _CODE_TABLES:
        _CODE_TABLES[key] = default_components(spark)
    return _CODE_TABLES[key]


def _member_id(custkey: str) -> Column:
    return F.concat(F.lit("M"), F.floor(F.col(custkey) / 5).cast("long").cast("string"))


def _mod(c: str, n: int) -> Column:
    return F.pmod(F.col(c), F.lit(n))


def _coded(prefix: str, value: Column, n: int) -> Column:
    """``prefix`` and ``value`` modulo ``n``, taken from the list of its ``n`` values."""
    return F.element_at(F.array(*[F.lit(f"{prefix}{k}") for k in range(n)]), (F.pmod(value, F.lit(n)) + 1).cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def read_tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def members(customer: DataFrame) -> DataFrame:
    k = F.floor(F.col("c_custkey") / 5)
    days = F.pmod(k * 7919, F.lit(14600)) + F.when(F.pmod(k, F.lit(5)) == 0, 14600).otherwise(0)
    return customer.select(_member_id("c_custkey").alias("member_id"),
                           F.date_sub(F.lit(DOB_ANCHOR), days.cast("int")).alias("dob"))


def _spans(orders: DataFrame) -> DataFrame:
    od = F.to_date("o_orderdate")
    return orders.select(
        _member_id("o_custkey").alias("member_id"),
        F.trunc(od, "month").alias("date_start"),
        F.last_day(F.add_months(od, 2)).alias("date_end"),
        F.when(F.col("o_orderstatus") == "P", "N").otherwise("Y").alias("cover_medical"))


def member_time(orders: DataFrame) -> DataFrame:
    return _spans(orders).distinct()


def member_months(spans: DataFrame) -> DataFrame:
    """Distinct months of the spans, which may repeat."""
    months = F.explode(F.sequence(F.col("date_start"), F.trunc("date_end", "month"), F.expr("interval 1 month")))
    return (spans.select("member_id", months.alias("elig_month"), "cover_medical").distinct()
            .select("member_id", F.col("elig_month").cast("date").alias("elig_month"),
                    F.lit(1.0).alias("memmos"), "cover_medical"))


def claim_lines(lineitem: DataFrame, orders: DataFrame, by_date: bool = False) -> DataFrame:
    """Claim lines; with ``by_date`` each partition holds them in the order of ``prm_fromdate``.

    The order is made on the source columns, before the many claim columns are derived: a row is
    then a tenth as wide, so a task's rows are sorted in memory.
    """
    o = orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("_day"))
    j = (lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
         .join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .withColumn("_from", F.date_add("_day", _mod("l_linenumber", 3).cast("int"))))
    if by_date:
        j = j.sortWithinPartitions("_from")
    # one expression for all later codes of a kind: a column each makes a generated method that the JVM won't compile
    j = j.select("*", F.transform(F.sequence(F.lit(4), F.lit(CODE_COLUMNS)), lambda k: F.when(
        F.pmod(F.col("l_partkey") + k, F.lit(16)) == 0, _coded("D", F.col("l_suppkey") + 3 * k, 60))).alias("_diags"),
        F.transform(F.sequence(F.lit(3), F.lit(CODE_COLUMNS)), lambda k: F.when(
            F.pmod(F.col("l_suppkey") + k, F.lit(32)) == 0, _coded("P", F.col("l_partkey") + k, 40))).alias("_procs"))
    od, from_date = F.col("_day"), F.col("_from")
    hcpcs = (F.when((_mod("l_partkey", 211) == 0) & (_mod("l_suppkey", 5) == 0), F.lit("HSP"))
             .otherwise(_coded("H", F.col("l_partkey"), 60)))
    revcode = (F.when((_mod("l_suppkey", 13) == 0) & (_mod("l_partkey", 101) == 0), F.lit("RHSP"))
               .otherwise(_coded("R", F.col("l_suppkey"), 20)))
    return j.select(
        _member_id("o_custkey").alias("member_id"),
        _s(F.col("l_orderkey")).alias("claimid"),
        _s(F.col("l_orderkey")).alias("caseadmitid"),
        F.concat(F.when(F.col("l_linenumber") == 7, "I").otherwise("O"), _s(F.col("l_linenumber"))).alias("prm_line"),
        from_date.alias("prm_fromdate"),
        F.date_add(from_date, _mod("l_partkey", 6).cast("int")).alias("prm_todate"),
        from_date.alias("fromdate"),
        od.alias("prm_fromdate_case"),
        F.date_add(od, _mod("o_orderkey", 8).cast("int")).alias("prm_todate_case"),
        hcpcs.alias("hcpcs"),
        revcode.alias("revcode"),
        F.lpad(_s(_mod("l_suppkey", 30)), 2, "0").alias("pos"),
        F.when(F.col("l_returnflag") == "R", F.lit("95")).alias("modifier"),
        F.when((F.col("l_returnflag") == "A") & (_mod("l_linenumber", 2) == 0), F.lit("GT")).alias("modifier2"),
        F.when(F.col("l_linestatus") == "O", F.lit("09")).otherwise(F.lit("10")).alias("icdversion"),
        _coded("D", F.col("l_suppkey"), 40).alias("icddiag1"),
        _coded("D", F.col("l_partkey"), 50).alias("icddiag2"),
        F.when(_mod("l_linenumber", 2) == 0,
               _coded("D", F.col("l_partkey") + F.col("l_suppkey"), 45)).alias("icddiag3"),
        F.when(_mod("l_partkey", 9) == 0, _coded("P", F.col("l_partkey"), 7)).alias("icdproc1"),
        *[F.col("_diags")[k - 4].alias(f"icddiag{k}") for k in range(4, CODE_COLUMNS + 1)],
        F.when((_mod("l_partkey", 97) == 0) & (_mod("l_suppkey", 7) == 0), F.lit("PX")).alias("icdproc2"),
        *[F.col("_procs")[k - 3].alias(f"icdproc{k}") for k in range(3, CODE_COLUMNS + 1)],
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 5), "Y").otherwise("N").alias("prm_denied_yn"),
        F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"))


def outclaims(lines: DataFrame) -> DataFrame:
    return lines.drop("l_partkey", "l_suppkey", "l_linenumber")


def outpharmacy(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("l_linenumber") == 4).select(
        "member_id", F.concat("claimid", F.lit("-"), _s(F.col("l_linenumber"))).alias("claimid"),
        "prm_fromdate", F.lpad(_s(_mod("l_partkey", 50)), 11, "0").alias("ndc"))


def inpdental(lines: DataFrame) -> DataFrame:
    code = (F.when(_mod("l_partkey", 6) == 0, "D0120").when(_mod("l_partkey", 6) == 1, "D0150")
            .when(_mod("l_partkey", 6) == 2, "D1110").when(_mod("l_partkey", 6) == 3, "D1206")
            .when(_mod("l_partkey", 6) == 4, "D2140").otherwise("D9999"))
    return lines.filter(_mod("l_partkey", 10) < 3).select(
        "member_id", "claimid", "fromdate", code.alias("hcpcs"), "modifier", "modifier2", "pos",
        _s(F.col("l_suppkey")).alias("providerid"), _s(F.col("l_linenumber")).alias("tooth"))


def providers(supplier: DataFrame) -> DataFrame:
    return supplier.select(_s(F.col("s_suppkey")).alias("prv_id"),
                           F.concat(F.lit("TX"), _s(_mod("s_nationkey", 12))).alias("prv_taxonomy_cd"))


def foster_care(orders: DataFrame, member: DataFrame) -> DataFrame:
    od = F.to_date("o_orderdate")
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        _member_id("o_custkey").alias("member_id"), od.alias("report_date"),
        F.when(_mod("o_orderkey", 10) == 0, F.lit("6050")).alias("branch_code"),
        F.date_sub(od, _mod("o_orderkey", 40).cast("int")).alias("eligibility_effective_date"))
    dobs = member.select("member_id", "dob").distinct()
    return urgent.join(dobs, "member_id").select("member_id", "report_date", "dob", "branch_code",
                                                  "eligibility_effective_date")


def predictions(customer: DataFrame) -> DataFrame:
    return customer.filter(F.col("c_acctbal") > 0).select(
        _member_id("c_custkey").alias("member_id"), (F.col("c_acctbal") / 10000.0).alias("er_visits_pred_prob"))


def derive_model(spark: SparkSession, sf_dir: str, by_date: bool = False) -> dict[str, DataFrame]:
    """The stageable claims-model tables as lazy DataFrames over the driver tables.

    ``lines`` is the joined claim-line table (lineitem x orders with the helper keys);
    the medical, pharmacy and dental claim tables are projections of it.  ``by_date`` puts the dated
    tables in date order within each partition.
    """
    def dated(df: DataFrame, column: str) -> DataFrame:
        return df.sortWithinPartitions(column) if by_date else df
    t = read_tables(spark, sf_dir, ["customer", "orders", "lineitem", "supplier"])
    member = members(t["customer"])
    return {
        "member": member,
        "member_time": dated(member_time(t["orders"]), "date_start"),
        "member_months": dated(member_months(_spans(t["orders"])), "elig_month"),
        "lines": claim_lines(t["lineitem"], t["orders"], by_date),
        "providers": providers(t["supplier"]),
        "foster_care": foster_care(t["orders"], member),
        "predictions": predictions(t["customer"]),
    }


def _claim_tables(model: dict) -> dict:
    lines = model.pop("lines")
    if isinstance(lines, Later):
        return model | {f.__name__: Later(lambda f=f: f(lines())) for f in (outclaims, outpharmacy, inpdental)}
    return model | {f.__name__: f(lines) for f in (outclaims, outpharmacy, inpdental)}


_STAGED: dict = {}
_STAGE_LOCK = threading.Lock()
# projections of small tables are read as they are
UNSTAGED = ("member", "providers", "predictions")


def _listing(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the source files, so changed data is staged anew."""
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    out = []
    for name in ("customer", "orders", "lineitem", "supplier"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(conf)
        out += [f"{s.getPath().toString()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(path)]
    return ";".join(sorted(out))


def _stage(spark: SparkSession, sf_dir: str) -> dict[str, Later]:
    """The derived claims model: each table is written once per session, when it is first read.

    The measures read the claims model many times (several branches per measure);
    staging it like an upstream data mart means every branch scans columnar files
    with pushed-down filters and pruned columns instead of re-deriving lineitem x
    orders.  The folder lives under the session's checkpoint directory (shared
    storage on a cluster); a lost executor only loses cached blocks, the files stay.
    """
    from qmeasures.session import ensure_checkpoint_dir
    app = spark.sparkContext.applicationId
    key = (app, sf_dir, _listing(spark, sf_dir))
    with _STAGE_LOCK:
        for old in [k for k in _STAGED if k[0] != app]:  # sessions that have ended
            del _STAGED[old]
        if key in _STAGED:
            return _STAGED[key]
        root = ensure_checkpoint_dir(spark).rstrip("/")
        tag = hashlib.sha1("|".join(key[1:]).encode()).hexdigest()[:10]

        def write(name: str, df: DataFrame) -> DataFrame:
            path = f"{root}/model-{app}-{tag}/{name}"
            df.write.mode("overwrite").parquet(path)
            return spark.read.parquet(path)

        # claim lines are written in service-date order within each file so the date
        # ranges the measures filter on can skip row groups by their min/max statistics
        _STAGED[key] = {name: Later(lambda df=df, name=name: df if name in UNSTAGED else write(name, df))
                        for name, df in derive_model(spark, sf_dir, by_date=True).items()}
        return _STAGED[key]


def stage_model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every table of the claims model, written now where that has not been done."""
    tables = _stage(spark, sf_dir)
    # independent tables: their write jobs run concurrently in the one application
    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(tables, pool.map(lambda table: table(), tables.values())))


def load_inputs(spark: SparkSession, sf_dir: str, staged: bool = True) -> ClaimsInputs:
    """Claims inputs for the driver tables (by default a staged model, each table written when it is first read)."""
    if staged:
        model = dict(_stage(spark, sf_dir))
    else:
        model = derive_model(spark, sf_dir)
    return ClaimsInputs(
        **_claim_tables(model),
        dental_taxonomy=spark.createDataFrame([(c,) for c in ALLOWED_TAXONOMY], "taxonomy_code string"),
        oha_codes=code_table(spark, OHA_CODES),
        hedis_codes=code_table(spark, HEDIS_CODES),
        medications=code_table(spark, MEDICATION_CODES),
        components=_components(spark),
    )
