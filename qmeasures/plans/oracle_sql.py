"""Independent SQL formulations (DuckDB dialect) of the registered queries.

Each query is written directly in SQL over the driver tables: a shared prefix of CTEs
rebuilds the claims model from ``customer / orders / lineitem / supplier`` and the
measure logic follows in plain SQL (window functions, a recursive CTE for the
anchored delivery grouping).  They serve as the value oracle for the Spark plans.
"""

from __future__ import annotations

from collections import defaultdict

from qmeasures.sources import adapter as A

MS, ME = "DATE '1998-01-01'", "DATE '1998-12-31'"
RUNOUT = "DATE '1998-08-01'"
LATEST_PAID = "DATE '1998-10-31'"

_BASE = {
    "cust": """cust AS (SELECT c_custkey, c_acctbal, 'M' || CAST(c_custkey // 5 AS VARCHAR) AS member_id,
                 c_custkey // 5 AS k FROM customer)""",
    "member": """member AS (SELECT member_id,
                 CAST(DATE '1998-12-31' - CAST(((k * 7919) % 14600 + CASE WHEN k % 5 = 0 THEN 14600 ELSE 0 END)
                      AS INTEGER) AS DATE) AS dob FROM cust)""",
    "mem": "mem AS (SELECT member_id, min(dob) AS dob FROM member GROUP BY member_id)",
    "ord": """ord AS (SELECT o_orderkey, o_custkey, 'M' || CAST(o_custkey // 5 AS VARCHAR) AS member_id,
                 CAST(o_orderdate AS DATE) AS od, o_orderstatus, o_orderpriority FROM orders)""",
    "member_time": """member_time AS (SELECT DISTINCT member_id, CAST(date_trunc('month', od) AS DATE) AS date_start,
                 CAST(last_day(od + INTERVAL 2 MONTH) AS DATE) AS date_end,
                 CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE 'Y' END AS cover_medical FROM ord)""",
    "member_months": """member_months AS (SELECT DISTINCT member_id, CAST(m AS DATE) AS elig_month,
                 CAST(1.0 AS DOUBLE) AS memmos, cover_medical FROM (
                 SELECT member_id, cover_medical, unnest(generate_series(CAST(date_start AS TIMESTAMP),
                   CAST(date_trunc('month', date_end) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM member_time))""",
    "lines": """lines AS (SELECT o.member_id, CAST(l.l_orderkey AS VARCHAR) AS claimid,
                 (CASE WHEN l.l_linenumber = 7 THEN 'I' ELSE 'O' END) || CAST(l.l_linenumber AS VARCHAR) AS prm_line,
                 o.od + CAST(l.l_linenumber % 3 AS INTEGER) AS prm_fromdate,
                 o.od + CAST(l.l_linenumber % 3 + l.l_partkey % 6 AS INTEGER) AS prm_todate,
                 o.od + CAST(l.l_linenumber % 3 AS INTEGER) AS fromdate,
                 o.od AS prm_fromdate_case,
                 o.od + CAST(o.o_orderkey % 8 AS INTEGER) AS prm_todate_case,
                 CASE WHEN l.l_partkey % 211 = 0 AND l.l_suppkey % 5 = 0 THEN 'HSP'
                      ELSE 'H' || CAST(l.l_partkey % 60 AS VARCHAR) END AS hcpcs,
                 CASE WHEN l.l_suppkey % 13 = 0 AND l.l_partkey % 101 = 0 THEN 'RHSP'
                      ELSE 'R' || CAST(l.l_suppkey % 20 AS VARCHAR) END AS revcode,
                 lpad(CAST(l.l_suppkey % 30 AS VARCHAR), 2, '0') AS pos,
                 CASE WHEN l.l_returnflag = 'R' THEN '95' END AS modifier,
                 CASE WHEN l.l_returnflag = 'A' AND l.l_linenumber % 2 = 0 THEN 'GT' END AS modifier2,
                 CASE WHEN l.l_linestatus = 'O' THEN '09' ELSE '10' END AS icdversion,
                 'D' || CAST(l.l_suppkey % 40 AS VARCHAR) AS icddiag1,
                 'D' || CAST(l.l_partkey % 50 AS VARCHAR) AS icddiag2,
                 CASE WHEN l.l_linenumber % 2 = 0 THEN 'D' || CAST((l.l_partkey + l.l_suppkey) % 45 AS VARCHAR) END
                      AS icddiag3,
                 CASE WHEN l.l_partkey % 9 = 0 THEN 'P' || CAST(l.l_partkey % 7 AS VARCHAR) END AS icdproc1,
                 CASE WHEN l.l_partkey % 97 = 0 AND l.l_suppkey % 7 = 0 THEN 'PX' END AS icdproc2,
                 """ + "\n                 ".join(
        [f"CASE WHEN (l.l_partkey + {k}) % 16 = 0 THEN 'D' || CAST((l.l_suppkey + {3 * k}) % 60 AS VARCHAR) END AS icddiag{k},"
         for k in range(4, 16)]
        + [f"CASE WHEN (l.l_suppkey + {k}) % 32 = 0 THEN 'P' || CAST((l.l_partkey + {k}) % 40 AS VARCHAR) END AS icdproc{k},"
           for k in range(3, 16)]) + """
                 CASE WHEN l.l_returnflag = 'N' AND l.l_linenumber = 5 THEN 'Y' ELSE 'N' END AS prm_denied_yn,
                 l.l_partkey, l.l_suppkey, l.l_linenumber
               FROM lineitem l JOIN ord o ON l.l_orderkey = o.o_orderkey)""",
    "outpharmacy": """outpharmacy AS (SELECT member_id, claimid || '-' || CAST(l_linenumber AS VARCHAR) AS claimid,
                 prm_fromdate, lpad(CAST(l_partkey % 50 AS VARCHAR), 11, '0') AS ndc FROM lines WHERE l_linenumber = 4)""",
    "inpdental": """inpdental AS (SELECT member_id, claimid, fromdate,
                 CASE l_partkey % 6 WHEN 0 THEN 'D0120' WHEN 1 THEN 'D0150' WHEN 2 THEN 'D1110'
                      WHEN 3 THEN 'D1206' WHEN 4 THEN 'D2140' ELSE 'D9999' END AS hcpcs,
                 modifier, modifier2, pos, CAST(l_suppkey AS VARCHAR) AS providerid,
                 CAST(l_linenumber AS VARCHAR) AS tooth FROM lines WHERE l_partkey % 10 < 3)""",
    "providers": """providers AS (SELECT CAST(s_suppkey AS VARCHAR) AS prv_id,
                 'TX' || CAST(s_nationkey % 12 AS VARCHAR) AS prv_taxonomy_cd FROM supplier)""",
    "foster_care": """foster_care AS (SELECT o.member_id, o.od AS report_date, m.dob,
                 CASE WHEN o.o_orderkey % 10 = 0 THEN '6050' END AS branch_code,
                 o.od - CAST(o.o_orderkey % 40 AS INTEGER) AS eligibility_effective_date
               FROM ord o JOIN (SELECT DISTINCT member_id, dob FROM member) m ON o.member_id = m.member_id
               WHERE o.o_orderpriority = '1-URGENT')""",
    "predictions": """predictions AS (SELECT member_id, c_acctbal / 10000.0 AS er_visits_pred_prob
               FROM cust WHERE c_acctbal > 0)""",
}

_DEPS = {"member": ["cust"], "mem": ["member"], "member_time": ["ord"], "member_months": ["member_time"],
         "lines": ["ord"], "outpharmacy": ["lines"], "inpdental": ["lines"], "foster_care": ["ord", "member"],
         "predictions": ["cust"], "providers": [], "cust": [], "ord": []}

_ORDER = ["cust", "member", "mem", "ord", "member_time", "member_months", "lines", "outpharmacy",
          "inpdental", "providers", "foster_care", "predictions"]


def prefix(*names: str) -> str:
    need = set()

    def add(n):
        if n not in need:
            need.add(n)
            for d in _DEPS.get(n, []):
                add(d)
    for n in names:
        add(n)
    return "WITH RECURSIVE " + ",\n".join(_BASE[n] for n in _ORDER if n in need)


def age(dob: str, at: str) -> str:
    return (f"(year({at}) - year({dob}) - CASE WHEN strftime({at}, '%m%d') < strftime({dob}, '%m%d') "
            f"THEN 1 ELSE 0 END)")


def fmt(d: str) -> str:
    return f"strftime({d}, '%m/%d/%Y')"


# ---- code-set predicates rendered as SQL text ------------------------------------

_COLS = {"CPT": "hcpcs", "HCPCS": "hcpcs", "CDT": "hcpcs", "DENTAL": "hcpcs", "UBREV": "revcode", "POS": "pos",
         "NDC": "ndc", "TOOTH": "tooth", "UBTOB": "billtype"}
CLAIM_COLS = ["hcpcs", "revcode", "pos", "modifier", "modifier2", *[f"icddiag{k}" for k in range(1, 16)],
              *[f"icdproc{k}" for k in range(1, 16)]]
DENTAL_COLS = ["hcpcs", "pos", "modifier", "modifier2", "tooth"]
PHARMACY_COLS = ["ndc"]


def _lst(codes) -> str:
    return "(" + ", ".join("'" + c.replace("'", "''") + "'" for c in sorted(codes)) + ")"


def _term(cs: str, rows, cols, alias: str) -> str:
    p = f"{alias}." if alias else ""
    cs = cs.upper()
    codes = {r[3] for r in rows}
    if cs in _COLS:
        c = _COLS[cs]
        return f"coalesce({p}{c} IN {_lst(codes)}, false)" if c in cols else "false"
    if cs == "MODIFIER":
        parts = [f"coalesce({p}{c} IN {_lst(codes)}, false)" for c in ("modifier", "modifier2") if c in cols]
        return "(" + " OR ".join(parts) + ")" if parts else "false"
    if cs.endswith("-DIAG"):
        diags = [c for c in cols if c.startswith("icddiag")]
        parts = []
        for r in rows:
            t = (r[5] or "all").lower()
            targets = diags[:1] if t == "primary" else diags[1:] if t == "secondary" else diags
            parts += [f"coalesce({p}{c} = '{r[3]}', false)" for c in targets]
        return "(" + " OR ".join(parts) + ")" if parts else "false"
    if cs.endswith("-PROC"):
        parts = [f"coalesce({p}{c} IN {_lst(codes)}, false)" for c in cols if c.startswith("icdproc")]
        return "(" + " OR ".join(parts) + ")" if parts else "false"
    return "false"


def pred(table_rows, measure: str, component: str, cols=CLAIM_COLS, alias: str = "") -> str:
    rows = [r for r in table_rows if r[0].lower() == measure.lower() and r[1].lower() == component.lower()]
    loose = defaultdict(list)
    groups = defaultdict(lambda: defaultdict(list))
    for r in rows:
        if r[4]:
            groups[r[4]][r[2]].append(r)
        else:
            loose[r[2]].append(r)
    terms = [_term(cs, rs, cols, alias) for cs, rs in loose.items()]
    for g in groups.values():
        terms.append("(" + " AND ".join(_term(cs, rs, cols, alias) for cs, rs in g.items()) + ")")
    return "(" + (" OR ".join(terms) if terms else "false") + ")"


def H(comp, **kw):
    return pred(A.HEDIS_CODES, kw.pop("measure"), comp, **kw)


def O(measure, comp, **kw):
    return pred(A.OHA_CODES, measure, comp, **kw)


def RX(measure, comp):
    return pred(A.MEDICATION_CODES, measure, comp, cols=PHARMACY_COLS)


def versioned(keys, alias=""):
    p = f"{alias}." if alias else ""
    parts = [f"({p}icddiag{i} IS NOT NULL AND {p}icdversion || '|' || {p}icddiag{i} IN {_lst(keys)})"
             for i in range(1, 16)]
    return "coalesce(" + " OR ".join(parts) + ", false)"


def gaps_sql(name: str, src: str, keys: list[str]) -> str:
    """CTEs ``<name>`` (keys, gap_cnt, gap_days) from ``src`` rows (keys, ws, we, date_start, date_end).

    Formulation: clipped spans ordered by (start, end); running max of earlier ends.
    """
    k = ", ".join(keys)
    on = " AND ".join(f"w.{c} = x.{c}" for c in keys)
    return f"""
{name}_win AS (SELECT {k}, min(ws) AS ws, min(we) AS we FROM {src} GROUP BY {k}),
{name}_clip AS (SELECT {k}, greatest(date_start, ws) AS s, least(date_end, we) AS e FROM {src}
    WHERE date_start IS NOT NULL AND date_end IS NOT NULL AND greatest(date_start, ws) <= least(date_end, we)),
{name}_ord AS (SELECT c.*, max(e) OVER (PARTITION BY {k} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    AS prev FROM {name}_clip c),
{name}_mid AS (SELECT x.{keys[0]}{''.join(', x.' + c for c in keys[1:])},
    sum(CASE WHEN x.s - coalesce(x.prev, w.ws - 1) > 1 THEN 1 ELSE 0 END) AS n,
    sum(greatest(x.s - coalesce(x.prev, w.ws - 1) - 1, 0)) AS d, max(x.e) AS maxe
    FROM {name}_ord x JOIN {name}_win w ON {on} GROUP BY {', '.join('x.' + c for c in keys)}),
{name} AS (SELECT w.{keys[0]}{''.join(', w.' + c for c in keys[1:])},
    CAST(coalesce(x.n, 0) + CASE WHEN w.we - coalesce(x.maxe, w.ws - 1) > 0 THEN 1 ELSE 0 END AS BIGINT) AS gap_cnt,
    CAST(coalesce(x.d, 0) + greatest(w.we - coalesce(x.maxe, w.ws - 1), 0) AS BIGINT) AS gap_days
    FROM {name}_win w LEFT JOIN {name}_mid x ON {on})"""


def _result_cols(den="denominator", num="numerator", comments="NULL", actionable="NULL"):
    return (f"CAST({den} AS DOUBLE) AS denominator, CAST({num} AS DOUBLE) AS numerator, "
            f"CAST({comments} AS VARCHAR) AS comments, CAST({actionable} AS DATE) AS comp_quality_date_actionable")


# ---- measures --------------------------------------------------------------------

def well_child_sql() -> str:
    m = "well_child_visits"
    return prefix("mem", "member_time", "lines") + f""",
excl AS (SELECT DISTINCT member_id FROM lines WHERE fromdate BETWEEN {MS} AND {ME}
    AND ({H('hospice_encounter', measure=m)} OR {H('hospice_intervention', measure=m)})),
prep AS (SELECT t.member_id, t.date_start, t.date_end FROM member_time t JOIN mem m ON t.member_id = m.member_id
    WHERE {age('m.dob', ME)} BETWEEN 3 AND 6),
lastend AS (SELECT member_id, max(date_end) AS e FROM prep GROUP BY member_id),
freq AS (SELECT e, count(*) AS c FROM lastend GROUP BY e),
emp AS (SELECT least(coalesce((SELECT max(e) FROM freq WHERE c >= 42), {ME}), {ME}) AS we),
gsrc AS (SELECT member_id, {MS} AS ws, (SELECT we FROM emp) AS we, date_start, date_end FROM prep),
{gaps_sql('gaps', 'gsrc', ['member_id'])},
any_elig AS (SELECT DISTINCT member_id FROM prep WHERE date_start <= {ME} AND date_end >= {MS}),
denom AS (SELECT g.member_id, CASE WHEN x.member_id IS NOT NULL THEN 1 ELSE 0 END AS excluded
    FROM gaps g JOIN any_elig a ON g.member_id = a.member_id LEFT JOIN excl x ON g.member_id = x.member_id
    WHERE g.gap_cnt <= 1 AND g.gap_days <= 45),
visits AS (SELECT member_id, max(fromdate) AS mrv,
    max(CASE WHEN fromdate BETWEEN {MS} AND {ME} THEN 1 ELSE 0 END) AS numerator FROM lines
    WHERE {H('well_care', measure=m)} AND NOT {H('telehealth_modifier', measure=m)}
      AND NOT {H('telehealth_pos', measure=m)} GROUP BY member_id)
SELECT d.member_id, {_result_cols(
        den="CASE WHEN d.excluded = 1 THEN 0 ELSE 1 END", num="coalesce(v.numerator, 0)",
        comments=f"CASE WHEN d.excluded = 1 THEN 'Excluded due to hospice status' "
                 f"WHEN v.mrv IS NOT NULL THEN 'Most recent visit performed ' || {fmt('v.mrv')} || "
                 f"CASE WHEN v.mrv BETWEEN {MS} AND {ME} THEN '' ELSE ' (not in performance year)' END "
                 f"ELSE 'No qualifying visit' END",
        actionable=f"CASE WHEN coalesce(v.numerator, 0) = 0 THEN {ME} END")}
FROM denom d LEFT JOIN visits v ON d.member_id = v.member_id"""


def _ed_core(predictions: bool = True) -> str:
    e = "ed_visits"
    probs = ("SELECT member_id, max(er_visits_pred_prob) AS p FROM predictions GROUP BY member_id" if predictions else
             "SELECT member_id, CAST(NULL AS DOUBLE) AS p FROM mem WHERE false")
    return prefix("mem", "member_months", "lines", "predictions") + f""",
hosp AS (SELECT DISTINCT member_id FROM lines WHERE prm_fromdate BETWEEN {MS} AND {ME}
    AND {O(e, 'denom_excl_hospice')}),
mm AS (SELECT member_id, sum(memmos) AS memmos FROM member_months WHERE elig_month BETWEEN {MS} AND {ME}
    AND elig_month < {RUNOUT} AND cover_medical = 'Y' GROUP BY member_id),
edl AS (SELECT member_id, prm_fromdate, prm_line, claimid, CASE WHEN {O(e, 'numer_excl_mh')} THEN 1 ELSE 0 END AS mh
    FROM lines WHERE {O(e, 'numer_cpt')} OR {O(e, 'numer_rev')} OR {O(e, 'numer_procs')}),
psych AS (SELECT DISTINCT member_id, claimid FROM lines WHERE {O(e, 'numer_excl_psych')}),
ipd AS (SELECT DISTINCT member_id, prm_fromdate FROM lines WHERE {O(e, 'numer_excl_ip_stay')}),
den AS (SELECT DISTINCT member_id, claimid FROM lines WHERE prm_denied_yn = 'Y'),
flagged AS (SELECT x.*,
    CASE WHEN EXISTS (SELECT 1 FROM ipd i WHERE i.member_id = x.member_id
        AND i.prm_fromdate - x.prm_fromdate BETWEEN 0 AND 1) THEN 1 ELSE 0 END AS ipf,
    CASE WHEN EXISTS (SELECT 1 FROM psych p WHERE p.member_id = x.member_id AND p.claimid = x.claimid)
        THEN 1 ELSE 0 END AS px,
    CASE WHEN EXISTS (SELECT 1 FROM den d WHERE d.member_id = x.member_id AND d.claimid = x.claimid)
        THEN 1 ELSE 0 END AS dn,
    CASE WHEN x.prm_fromdate BETWEEN {MS} AND {ME} THEN 1 ELSE 0 END AS iy,
    CASE WHEN x.prm_fromdate BETWEEN {MS} AND {ME} AND x.prm_fromdate >= {RUNOUT} THEN 1 ELSE 0 END AS ro
    FROM edl x),
withmin AS (SELECT f.*, min(prm_fromdate) OVER (PARTITION BY member_id, claimid) AS min_fromdate FROM flagged f),
visits AS (SELECT member_id, min_fromdate, max(iy) AS iy, min(ro) AS ro, max(dn) AS dn FROM withmin
    WHERE ipf = 0 AND mh = 0 AND px = 0 AND NOT starts_with(upper(coalesce(prm_line, '')), 'I')
    GROUP BY member_id, min_fromdate HAVING max(dn) <> 1),
prior AS (SELECT member_id, max(min_fromdate) AS vd FROM visits WHERE iy = 0 GROUP BY member_id),
pr AS ({probs}),
num AS (SELECT member_id, sum(CASE WHEN ro = 1 THEN 0 ELSE 1 END) AS n FROM visits WHERE iy = 1 GROUP BY member_id),
ranked AS (SELECT member_id, min_fromdate, ro,
    row_number() OVER (PARTITION BY member_id ORDER BY min_fromdate DESC) AS rk FROM visits WHERE iy = 1),
txt AS (SELECT member_id, 'Recent Visit(s):  ' || string_agg({fmt('min_fromdate')} ||
    CASE WHEN ro = 1 THEN ' (will qualify soon)' ELSE '' END, ', ' ORDER BY rk) AS c
    FROM ranked WHERE rk <= 3 GROUP BY member_id),
dd AS (SELECT m.member_id, pr.p, CASE WHEN h.member_id IS NOT NULL THEN 0.0 ELSE m.memmos / 1000.0 END AS den,
    CASE WHEN h.member_id IS NOT NULL THEN 'Excluded due to hospice status'
         ELSE nullif(concat_ws('; ',
            CASE WHEN pv.vd IS NOT NULL THEN 'Most Recent Visit: ' || {fmt('pv.vd')} END,
            CASE WHEN pr.p IS NOT NULL THEN 'Probability of ED Visit Next 6 Months: ' ||
                 CAST(CAST(round(pr.p * 100) AS BIGINT) AS VARCHAR) || '%' END), '') END AS dc
    FROM mm m LEFT JOIN prior pv ON m.member_id = pv.member_id LEFT JOIN pr ON m.member_id = pr.member_id
    LEFT JOIN hosp h ON m.member_id = h.member_id),
ed_all AS (SELECT d.member_id,
    CASE WHEN d.den = 0 THEN 0 ELSE coalesce(n.n, 0) END AS numerator, d.den AS denominator,
    CASE WHEN d.den = 0 THEN d.dc ELSE coalesce(t.c, d.dc) END AS comments,
    CASE WHEN (CASE WHEN d.den = 0 THEN 0 ELSE coalesce(n.n, 0) END) = 0
         THEN CASE WHEN d.p >= 0.5 THEN {ME} END
         ELSE CASE WHEN d.p >= 0.25 THEN {ME} END END AS comp_quality_date_actionable
    FROM dd d LEFT JOIN num n ON d.member_id = n.member_id LEFT JOIN txt t ON d.member_id = t.member_id)"""


def ed_all_sql(predictions: bool = True) -> str:
    return _ed_core(predictions) + f"""
SELECT member_id, {_result_cols(comments='comments', actionable='comp_quality_date_actionable')} FROM ed_all"""


def ed_mi_sql() -> str:
    return _ed_core() + f""",
mi AS (SELECT member_id FROM lines WHERE prm_fromdate > {ME} - INTERVAL 36 MONTH AND prm_fromdate < {ME}
    AND {O('ED_Visits_MI', 'denominator')} GROUP BY member_id HAVING count(DISTINCT prm_fromdate) >= 2),
adults AS (SELECT member_id FROM mem WHERE {age('dob', ME)} >= 18)
SELECT e.member_id, {_result_cols(num='coalesce(e.numerator, 0)', den='e.denominator', comments='e.comments',
                                 actionable='e.comp_quality_date_actionable')}
FROM mi JOIN adults a ON mi.member_id = a.member_id JOIN ed_all e ON mi.member_id = e.member_id"""


def custody_sql(dental_table: bool = True) -> str:
    d = "DHS_assessments"
    joint = "c.pm" if dental_table else "false"          # the joint rule applies only with a dental table
    dental_rows = "true" if dental_table else "false"
    mh_keys = sorted({("09|" if r[2].upper() == "ICD9CM-DIAG" else "10|") + r[3] for r in A.OHA_CODES
                      if r[0] == d and r[1] == "Numerator_PhysMent" and r[2].upper().endswith("-DIAG")})
    combined_cpt = sorted({r[3] for r in A.OHA_CODES if r[0] == d and r[1] == "Numerator_PhysMent" and r[2] == "CPT"})
    lo, hi = "DATE '1997-11-01'", "DATE '1998-10-31'"
    return prefix("member_time", "lines", "inpdental", "foster_care") + f""",
lastend AS (SELECT member_id, max(date_end) AS e FROM member_time GROUP BY member_id),
freq AS (SELECT e, count(*) AS c FROM lastend GROUP BY e),
emp AS (SELECT least(coalesce((SELECT max(e) FROM freq WHERE c >= 42), {ME}), {ME}) AS we),
notes AS (SELECT member_id, report_date, eligibility_effective_date, report_date - 30 AS m30,
    least(report_date + 60, (SELECT we FROM emp)) AS p60, {age('dob', 'report_date')} AS rage
    FROM foster_care WHERE report_date BETWEEN {lo} AND {hi} AND {age('dob', 'report_date')} <= 17
      AND (branch_code IS NULL OR branch_code NOT IN ('6050', '0060'))),
sa AS (SELECT n.member_id, n.report_date, n.report_date AS ws, least(n.p60, {hi}) AS we, t.date_start, t.date_end
    FROM notes n LEFT JOIN member_time t ON n.member_id = t.member_id),
sb AS (SELECT n.member_id, n.report_date, n.p60 AS ws, least(n.p60, {hi}) AS we, t.date_start, t.date_end
    FROM notes n LEFT JOIN member_time t ON n.member_id = t.member_id),
{gaps_sql('ga', 'sa', ['member_id', 'report_date'])},
{gaps_sql('gb', 'sb', ['member_id', 'report_date'])},
dmem AS (SELECT DISTINCT member_id, report_date, eligibility_effective_date, m30, p60, rage FROM notes),
denom AS (SELECT d.*, a.gap_cnt, b.gap_cnt AS dgc FROM dmem d
    LEFT JOIN ga a ON d.member_id = a.member_id AND d.report_date = a.report_date
    LEFT JOIN gb b ON d.member_id = b.member_id AND d.report_date = b.report_date
    WHERE b.gap_cnt = 0 AND d.eligibility_effective_date >= d.m30),
cl AS (SELECT member_id, prm_fromdate, {O(d, 'Numerator_Physical')} AS ph, {O(d, 'Numerator_Mental')} AS mn,
    {O(d, 'Numerator_Dental')} AS de, {O(d, 'Numerator_PRTS')} AS pr,
    (coalesce(hcpcs IN {_lst(combined_cpt)}, false) AND {versioned(mh_keys)}) AS pm
    FROM lines WHERE prm_fromdate BETWEEN {MS} AND {ME}
      AND ({O(d, 'Numerator_Physical')} OR {O(d, 'Numerator_Mental')} OR {O(d, 'Numerator_Dental')}
           OR {O(d, 'Numerator_PRTS')})),
fl AS (SELECT c.member_id, x.report_date,
        CASE WHEN {joint} THEN 1 WHEN c.prm_fromdate BETWEEN x.m30 AND x.p60 AND (c.ph OR c.pr) THEN 1 ELSE 0 END AS phys,
        CASE WHEN {joint} THEN 1 WHEN c.prm_fromdate BETWEEN x.m30 AND x.p60 AND (c.mn OR c.pr) THEN 1 ELSE 0 END AS ment,
        CASE WHEN c.prm_fromdate BETWEEN x.m30 AND x.p60 AND c.de THEN 1 ELSE 0 END AS dent
    FROM cl c JOIN denom x ON c.member_id = x.member_id
    UNION ALL
    SELECT i.member_id, x.report_date, 0, 0, CASE WHEN i.fromdate BETWEEN x.m30 AND x.p60 THEN 1 ELSE 0 END
    FROM inpdental i JOIN denom x ON i.member_id = x.member_id
    WHERE {dental_rows} AND i.fromdate BETWEEN {MS} AND {ME} AND {O(d, 'Numerator_Dental', cols=DENTAL_COLS, alias='i')}),
agg AS (SELECT member_id, report_date, max(phys) AS ph, max(ment) AS mt, max(dent) AS dt FROM fl
    GROUP BY member_id, report_date),
res AS (SELECT x.member_id, x.report_date, x.gap_cnt, x.dgc,
    CASE WHEN (x.rage >= 4 AND a.ph = 1 AND a.mt = 1 AND a.dt = 1) OR (x.rage >= 1 AND x.rage < 4 AND a.ph = 1
         AND a.dt = 1) OR (x.rage < 1 AND a.ph = 1) THEN 1 ELSE 0 END AS num
    FROM denom x LEFT JOIN agg a ON x.member_id = a.member_id AND x.report_date = a.report_date),
rows_ AS (SELECT member_id, num,
    CASE WHEN dgc = 0 AND num = 1 THEN 1 WHEN gap_cnt = 0 THEN 1 ELSE 0 END AS den,
    CASE WHEN num = 0 AND report_date + 60 > {LATEST_PAID} THEN report_date + 60 END AS act,
    'DHS Notification Date: ' || {fmt('report_date')} || '; ' ||
    CASE WHEN report_date + 60 <= {LATEST_PAID} THEN 'Assessment period ended'
         ELSE 'Assessment period ends ' || {fmt('report_date + 60')} END AS cmt FROM res)
SELECT member_id, {_result_cols(den='sum(den)', num='sum(num)', comments='cmt', actionable='act')}
FROM rows_ GROUP BY member_id, act, cmt"""




def _oral_core() -> str:
    m = "diabetes_oral_eval"
    comps = [c for mm, _, c in __import__("qmeasures.sources.refdata", fromlist=["x"]).HEDIS_MAPPING if mm == m]
    flags = ",\n    ".join(f"CASE WHEN {H(c, measure=m)} THEN 1 ELSE 0 END AS {c}" for c in comps)
    maxes = ", ".join(f"max({c}) AS {c}" for c in comps)
    prior_s, prior_e = "DATE '1997-01-01'", "DATE '1997-12-31'"

    def on(c):
        return f"({c} <> 0)"
    tele = f"({on('telehealth_modifier')} OR {on('telehealth_pos')})"
    op = f"({on('outpatient')} OR {on('observation')} OR {on('ed')})"
    derived = {
        "acute_ip_diabetes": f"{on('acute_inpatient')} AND {on('diabetes')} AND NOT {tele}",
        "nonacute_ip_diabetes": f"{on('nonacute_inpatient')} AND {on('diabetes')} AND NOT {tele}",
        "other_outpatient_non_tele": f"{op} AND {on('diabetes')} AND NOT {tele}",
        "other_outpatient_tele": f"{op} AND {on('diabetes')} AND {tele}",
        "telephone_diabetes": f"{on('telephone_visits')} AND {on('diabetes')}",
        "online_assessments_diabetes": f"{on('online_assessments')} AND {on('diabetes')}",
        "acute_ip_advanced_illness": f"{on('acute_inpatient')} AND {on('advanced_illness')}",
        "any_outpatient_advanced_illness": f"({op} OR {on('nonacute_inpatient')}) AND {on('advanced_illness')}",
    }
    dsql = ",\n    ".join(f"CASE WHEN {v} THEN 1 ELSE 0 END AS {k}" for k, v in derived.items())
    sums = ", ".join(f"sum({c}) AS {c}" for c in comps + list(derived) + ["tvn", "tvt"])
    return prefix("mem", "member_time", "lines", "outpharmacy", "inpdental") + f""",
adults AS (SELECT member_id, {age('dob', ME)} AS age FROM mem WHERE {age('dob', ME)} >= 18),
cl AS (SELECT member_id, prm_fromdate, claimid,
    {flags}
    FROM lines WHERE member_id IN (SELECT member_id FROM adults) AND prm_fromdate BETWEEN {prior_s} AND {ME}),
clm AS (SELECT member_id, prm_fromdate, claimid, {maxes} FROM cl GROUP BY member_id, prm_fromdate, claimid),
der0 AS (SELECT *, {dsql},
    CASE WHEN prm_fromdate BETWEEN {MS} AND {ME} THEN 'current_year'
         WHEN prm_fromdate BETWEEN {prior_s} AND {prior_e} THEN 'prior_year' END AS tp FROM clm),
der AS (SELECT *, greatest(nonacute_ip_diabetes, other_outpatient_non_tele) AS tvn,
    greatest(other_outpatient_tele, telephone_diabetes, online_assessments_diabetes) AS tvt FROM der0),
per AS (SELECT member_id, tp, {sums} FROM der WHERE tp IS NOT NULL GROUP BY member_id, tp),
medm AS (SELECT DISTINCT member_id FROM per WHERE acute_ip_diabetes >= 1 OR tvn >= 2 OR (tvn >= 1 AND tvt >= 1)),
rx AS (SELECT DISTINCT member_id FROM outpharmacy WHERE member_id IN (SELECT member_id FROM adults)
    AND {RX(m, 'diabetes_medications')} AND prm_fromdate BETWEEN {prior_s} AND {ME}),
rxx AS (SELECT DISTINCT member_id FROM outpharmacy WHERE member_id IN (SELECT member_id FROM adults)
    AND {RX(m, 'dementia_medications')} AND prm_fromdate BETWEEN {prior_s} AND {ME}),
dm AS (SELECT member_id FROM medm UNION SELECT member_id FROM rx),
ex AS (SELECT member_id,
    max(CASE WHEN tp = 'current_year' AND (hospice_encounter <> 0 OR hospice_intervention <> 0) THEN 1 ELSE 0 END) AS hosp,
    max(CASE WHEN tp = 'current_year' AND (frailty_device <> 0 OR frailty_diagnosis <> 0 OR frailty_encounter <> 0
        OR frailty_symptom <> 0) THEN 1 ELSE 0 END) AS frail,
    sum(acute_ip_advanced_illness) AS aa, sum(any_outpatient_advanced_illness) AS oa,
    sum(diabetes) AS dtot, sum(diabetes_exclusions) AS dex, count(*) AS n FROM per GROUP BY member_id),
excl AS (SELECT e.member_id FROM ex e JOIN adults a ON e.member_id = a.member_id
    LEFT JOIN rxx r ON e.member_id = r.member_id
    WHERE e.hosp = 1 OR (a.age >= 66 AND e.frail = 1 AND (e.aa >= 1 OR e.oa >= 2 OR r.member_id IS NOT NULL))
       OR (e.n = 1 AND e.dex <> 0 AND e.dtot = 0)),
gsrc AS (SELECT t.member_id, {MS} AS ws, least({ME}, {LATEST_PAID}) AS we, t.date_start, t.date_end
    FROM member_time t WHERE t.member_id IN (SELECT member_id FROM dm)),
{gaps_sql('gaps', 'gsrc', ['member_id'])},
denom AS (SELECT member_id FROM gaps WHERE gap_days <= 45 AND gap_cnt <= 1
    AND member_id NOT IN (SELECT member_id FROM excl)),
numer AS (SELECT member_id, max(CASE WHEN {O(m, 'numerator', cols=DENTAL_COLS)} THEN 1 ELSE 0 END) AS nf
    FROM inpdental WHERE fromdate BETWEEN {MS} AND {ME} GROUP BY member_id)"""


def oral_eval_sql() -> str:
    return _oral_core() + f"""
SELECT d.member_id, {_result_cols(den='1', num='CASE WHEN n.nf = 1 THEN 1 ELSE 0 END')}
FROM denom d LEFT JOIN numer n ON d.member_id = n.member_id"""


def _dental_long_sql() -> str:
    s = "dental_services"
    return prefix("mem", "member_time", "inpdental", "providers") + f""",
bucket AS (SELECT member_id, CASE WHEN a < 1 THEN '0-1' WHEN a BETWEEN 1 AND 5 THEN '1_to_5'
    WHEN a BETWEEN 6 AND 14 THEN '6_to_14' WHEN a BETWEEN 15 AND 17 THEN '15_to_17'
    WHEN a BETWEEN 18 AND 25 THEN '18_to_25' WHEN a BETWEEN 26 AND 65 THEN '26_to_65' ELSE '65+' END AS age_bucket
    FROM (SELECT member_id, {age('dob', ME)} AS a FROM mem)),
sp AS (SELECT t.member_id, b.age_bucket, t.date_start AS os, t.date_end AS oe,
    greatest(t.date_start, {MS}) AS cs, least(t.date_end, {ME}) AS ce
    FROM member_time t JOIN bucket b ON t.member_id = b.member_id WHERE t.date_end >= {MS} AND t.date_start <= {ME}),
lagged AS (SELECT *, lag(ce) OVER (PARTITION BY member_id, age_bucket ORDER BY os, oe) AS prev FROM sp),
runs AS (SELECT *, sum(CASE WHEN prev IS NULL OR cs - prev <> 1 THEN 1 ELSE 0 END)
    OVER (PARTITION BY member_id, age_bucket ORDER BY os, oe ROWS UNBOUNDED PRECEDING) AS isl FROM lagged),
isl AS (SELECT member_id, age_bucket, isl, sum(ce - cs + 1) AS days FROM runs GROUP BY member_id, age_bucket, isl),
den AS (SELECT DISTINCT member_id, age_bucket FROM isl WHERE days >= 180),
dl AS (SELECT d.member_id, p.prv_taxonomy_cd,
    CASE WHEN {O(s, 'diagnostic_dental', cols=DENTAL_COLS, alias='d')} THEN 1 ELSE 0 END AS dd,
    CASE WHEN {O(s, 'preventive_dental', cols=DENTAL_COLS, alias='d')} THEN 1 ELSE 0 END AS pd,
    CASE WHEN {O(s, 'dental_treatment', cols=DENTAL_COLS, alias='d')} THEN 1 ELSE 0 END AS td
    FROM inpdental d LEFT JOIN providers p ON d.providerid = p.prv_id WHERE d.fromdate BETWEEN {MS} AND {ME}),
pt AS (SELECT member_id, prv_taxonomy_cd, max(greatest(dd, pd, td)) AS anyd, max(dd) AS dd, max(pd) AS pd,
    max(td) AS td FROM dl GROUP BY member_id, prv_taxonomy_cd),
mf AS (SELECT member_id, max(anyd) AS anyd, max(dd) AS dd, max(pd) AS pd, max(td) AS td FROM pt
    WHERE prv_taxonomy_cd IN {_lst(A.ALLOWED_TAXONOMY)} GROUP BY member_id),
wide AS (SELECT d.member_id, d.age_bucket, coalesce(f.anyd, 0) AS anyd, coalesce(f.dd, 0) AS dd,
    coalesce(f.pd, 0) AS pd, coalesce(f.td, 0) AS td FROM den d LEFT JOIN mf f ON d.member_id = f.member_id),
long AS (SELECT member_id, age_bucket, 'any_dental_' || age_bucket AS measure, anyd AS numerator FROM wide
    UNION ALL SELECT member_id, age_bucket, 'diag_dental_' || age_bucket, dd FROM wide
    UNION ALL SELECT member_id, age_bucket, 'prev_dental_' || age_bucket, pd FROM wide
    UNION ALL SELECT member_id, age_bucket, 'treat_dental_' || age_bucket, td FROM wide)"""


def prev_dental_sql() -> str:
    return _dental_long_sql() + f"""
SELECT member_id, measure, {_result_cols(den='1', num='numerator',
                                          actionable=f"CASE WHEN numerator = 0 THEN {ME} END")}
FROM long WHERE measure IN ('prev_dental_1_to_5', 'prev_dental_6_to_14')"""


def dental_long_sql() -> str:
    return _dental_long_sql() + """
SELECT member_id, age_bucket, measure, CAST(numerator AS BIGINT) AS numerator FROM long"""


def _prenatal_core() -> str:
    m = "prenatal_postpartum_care"
    comps = [c for mm, _, c in __import__("qmeasures.sources.refdata", fromlist=["x"]).HEDIS_MAPPING
             if mm == m and c not in ("pregnancy_diagnosis", "cervical_cytology_result")]
    flags = ",\n    ".join(f"{H(c, measure=m)} AS {c}" for c in comps)
    preg = sorted("10|" + r[3] for r in A.HEDIS_CODES if r[0] == m and r[1] == "pregnancy_diagnosis"
                  and r[2].upper() == "ICD10CM-DIAG")
    return prefix("member_time", "lines") + f""",
fl AS (SELECT member_id, prm_fromdate, prm_todate,
    {flags},
    {versioned(preg)} AS preg FROM lines),
dlv AS (SELECT DISTINCT member_id, prm_fromdate, prm_todate FROM fl WHERE deliveries
    AND prm_todate BETWEEN DATE '1997-10-08' AND DATE '1998-10-07'),
ordd AS (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY prm_fromdate, prm_todate) AS rn FROM dlv),
rec(member_id, rn, prm_todate, gid, wend) AS (
    SELECT member_id, rn, prm_todate, 0, prm_todate + 60 FROM ordd WHERE rn = 1
    UNION ALL
    SELECT o.member_id, o.rn, o.prm_todate,
        CASE WHEN o.prm_todate > r.wend THEN r.gid + 1 ELSE r.gid END,
        CASE WHEN o.prm_todate > r.wend THEN o.prm_todate + 60 ELSE r.wend END
    FROM rec r JOIN ordd o ON o.member_id = r.member_id AND o.rn = r.rn + 1),
dd AS (SELECT member_id, gid, max(prm_todate) AS delivery_date FROM rec GROUP BY member_id, gid),
cov AS (SELECT member_id, date_start, date_end FROM member_time WHERE cover_medical = 'Y'),
dmt AS (SELECT d.member_id, d.delivery_date, d.delivery_date - 43 AS ws, d.delivery_date + 60 AS we,
    c.date_start, c.date_end FROM dd d JOIN cov c ON d.member_id = c.member_id),
{gaps_sql('dgaps', 'dmt', ['member_id', 'delivery_date'])},
lg AS (SELECT *, lag(date_end) OVER (PARTITION BY member_id, delivery_date ORDER BY date_start, date_end) AS prev
    FROM dmt),
seg AS (SELECT *, sum(CASE WHEN prev IS NULL OR date_start - prev <> 1 THEN 1 ELSE 0 END)
    OVER (PARTITION BY member_id, delivery_date ORDER BY date_start, date_end ROWS UNBOUNDED PRECEDING) AS sid
    FROM lg),
segw AS (SELECT member_id, delivery_date, sid, min(date_start) AS ss, max(date_end) AS se FROM seg
    GROUP BY member_id, delivery_date, sid),
ov AS (SELECT g.member_id, g.delivery_date, g.gap_cnt, s.ss FROM dgaps g JOIN segw s
    ON g.member_id = s.member_id AND g.delivery_date = s.delivery_date
    WHERE s.ss <= g.delivery_date AND s.se >= g.delivery_date - 280),
lastseg AS (SELECT member_id, delivery_date, max(gap_cnt) AS gap_cnt, max(ss) AS ss FROM ov
    GROUP BY member_id, delivery_date),
win AS (SELECT member_id, delivery_date, gap_cnt,
    CASE WHEN delivery_date - ss <= 219 THEN ss ELSE delivery_date - 280 END AS ps,
    CASE WHEN delivery_date - ss <= 219 THEN ss + 42 ELSE delivery_date - 176 END AS pe,
    delivery_date + 7 AS qs, delivery_date + 84 AS qe FROM lastseg),
mf AS (SELECT member_id, max(CASE WHEN non_live_births THEN 1 ELSE 0 END) AS nl,
    max(CASE WHEN hospice_encounter OR hospice_intervention THEN 1 ELSE 0 END) AS hs FROM fl GROUP BY member_id),
vis AS (SELECT member_id, prm_todate, (prenatal_bundled OR standalone_prenatal OR (prenatal_visits AND preg)) AS pre,
    ((postpartum_visits OR cervical_cytology_lab OR postpartum_bundled)
      AND NOT (acute_inpatient OR acute_inpatient_pos)) AS post FROM fl),
tm AS (SELECT w.member_id, w.delivery_date,
    max(CASE WHEN v.pre AND v.prm_todate BETWEEN w.ps AND w.pe THEN 1 ELSE 0 END) AS npre,
    max(CASE WHEN v.post AND v.prm_todate BETWEEN w.qs AND w.qe THEN 1 ELSE 0 END) AS npost
    FROM win w JOIN vis v ON w.member_id = v.member_id WHERE v.pre OR v.post GROUP BY w.member_id, w.delivery_date),
res AS (SELECT w.member_id,
    CASE WHEN coalesce(f.nl, 0) <> 0 OR w.gap_cnt <> 0 OR coalesce(f.hs, 0) <> 0 THEN 0 ELSE 1 END AS den,
    coalesce(t.npre, 0) AS npre, coalesce(t.npost, 0) AS npost
    FROM win w LEFT JOIN tm t ON w.member_id = t.member_id AND w.delivery_date = t.delivery_date
    LEFT JOIN mf f ON w.member_id = f.member_id),
summ AS (SELECT member_id, measure, sum(den) AS denominator, sum(num) AS numerator FROM (
    SELECT member_id, 'prenatal_care' AS measure, den, npre AS num FROM res
    UNION ALL SELECT member_id, 'postpartum_care', den, npost FROM res) GROUP BY member_id, measure)"""


def prenatal_sql(measure: str) -> str:
    return _prenatal_core() + f"""
SELECT member_id, {_result_cols()} FROM summ WHERE measure = '{measure}' AND denominator <> 0"""


def _aod_core() -> str:
    a = "aod"
    comps = [c for mm, _, c in __import__("qmeasures.sources.refdata", fromlist=["x"]).HEDIS_MAPPING if mm == a]
    flags = ",\n    ".join(f"CASE WHEN {H(c, measure=a)} THEN 1 ELSE 0 END AS {c}" for c in comps)
    maxes = ", ".join(f"max({c}) AS {c}" for c in comps)
    nulls = ", ".join(f"NULL AS {c}" for c in comps)

    def on(c):
        return f"coalesce({c} <> 0, false)"
    visit = (f"({on('iet_standalone_visits')} OR ({on('iet_visits_grp_1')} AND {on('iet_pos_grp_1')}) OR "
             f"({on('iet_visits_grp_2')} AND {on('iet_pos_grp_2')}) OR {on('observation')} OR {on('ip_stay')} OR "
             f"{on('telephone_visits')} OR {on('online_assessments')})")
    acute = f"({on('detox')} OR {on('ED')})"

    def ep(dep):
        return f"CAST({on(dep)} AND ({visit} OR {acute}) AS INTEGER)"

    def tr(dep):
        return f"CAST({on(dep)} AND {visit} AS INTEGER)"
    return prefix("mem", "member_time", "lines", "outpharmacy") + f""",
adults AS (SELECT member_id FROM mem WHERE {age('dob', ME)} >= 18),
cl AS (SELECT member_id, claimid, prm_fromdate, prm_fromdate_case AS fc, prm_todate_case AS tc,
    prm_todate_case - {MS} AS dsi,
    {flags}
    FROM lines WHERE prm_fromdate BETWEEN DATE '1997-11-02' AND {ME} AND member_id IN (SELECT member_id FROM adults)),
med AS (SELECT member_id, fc, tc, claimid, max(prm_fromdate) AS pf, max(dsi) AS dsi, {maxes}
    FROM cl GROUP BY member_id, fc, tc, claimid),
rx AS (SELECT member_id, claimid, prm_fromdate AS pf, prm_fromdate AS fc, prm_fromdate AS tc,
    CASE WHEN {RX(a, 'alcohol_treatment_meds')} THEN 1 ELSE 0 END AS arx,
    CASE WHEN {RX(a, 'opioid_treatment_meds')} THEN 1 ELSE 0 END AS orx
    FROM outpharmacy WHERE member_id IN (SELECT member_id FROM adults)),
eps0 AS (SELECT member_id, claimid, pf, fc, tc, dsi, 'med' AS src, {', '.join(comps)},
        CAST(NULL AS INTEGER) AS arx, CAST(NULL AS INTEGER) AS orx FROM med
    UNION ALL
    SELECT member_id, claimid, pf, fc, tc, NULL, 'rx', {nulls}, arx, orx FROM rx),
eps AS (SELECT *, {ep('alc_abuse_dependence')} AS alc_ep, {tr('alc_abuse_dependence')} AS alc_tr,
    {ep('opioid_abuse_dependence')} AS op_ep, {tr('opioid_abuse_dependence')} AS op_tr,
    {ep('other_abuse_dependence')} AS ot_ep, {tr('other_abuse_dependence')} AS ot_tr,
    CAST({on('aod_med_treatment')} OR {on('arx')} AS INTEGER) AS alc_rx,
    CAST({on('aod_med_treatment')} OR {on('orx')} AS INTEGER) AS op_rx FROM eps0),
ipr AS (SELECT *, lag(tc) OVER (PARTITION BY member_id ORDER BY fc, tc) AS prevtc FROM eps WHERE ip_stay = 1),
ipc AS (SELECT *, sum(CASE WHEN prevtc IS NOT NULL AND fc - prevtc > 1 THEN 1 ELSE 0 END)
    OVER (PARTITION BY member_id ORDER BY fc, tc ROWS UNBOUNDED PRECEDING) AS sid FROM ipr),
stays AS (SELECT member_id, sid, min(fc) AS sfc, max(tc) AS stc FROM ipc GROUP BY member_id, sid),
pot AS (SELECT i.member_id, i.claimid, s.sfc AS fc, s.stc AS tc, i.dsi, i.alc_ep, i.op_ep, i.ot_ep, i.ip_stay,
        0 AS srcn, i.fc AS ofc, i.tc AS otc
    FROM ipc i JOIN stays s ON i.member_id = s.member_id AND i.sid = s.sid
    UNION ALL
    SELECT member_id, claimid, fc, tc, dsi, alc_ep, op_ep, ot_ep, ip_stay,
        CASE WHEN src = 'med' THEN 1 ELSE 2 END, fc, tc FROM eps WHERE ip_stay IS NULL OR ip_stay <> 1),
idx AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY member_id
        ORDER BY fc, tc DESC, srcn, ofc, otc, claimid) AS rn FROM pot
        WHERE (alc_ep = 1 OR op_ep = 1 OR ot_ep = 1) AND dsi >= 0) WHERE rn = 1),
aodev AS (SELECT member_id, fc FROM eps WHERE {on('aod_abuse_dependence')} OR {on('aod_med_treatment')}
    OR alc_rx = 1 OR op_rx = 1),
neg AS (SELECT DISTINCT i.member_id FROM idx i JOIN aodev e ON i.member_id = e.member_id
    WHERE i.fc - e.fc > 0 AND i.fc - e.fc < 60),
hosp AS (SELECT DISTINCT member_id FROM med WHERE (hospice_encounter <> 0 OR hospice_intervention <> 0)
    AND fc BETWEEN {MS} AND {ME}),
gsrc AS (SELECT i.member_id, i.tc, i.tc - 60 AS ws, i.tc + 48 AS we, t.date_start, t.date_end
    FROM idx i LEFT JOIN member_time t ON i.member_id = t.member_id),
{gaps_sql('igaps', 'gsrc', ['member_id', 'tc'])},
den AS (SELECT i.member_id, i.claimid, i.tc AS iesd, i.alc_ep, i.op_ep, i.ot_ep, i.ip_stay FROM idx i
    JOIN igaps g ON i.member_id = g.member_id
    WHERE g.gap_cnt = 0 AND i.member_id NOT IN (SELECT member_id FROM neg)
      AND i.member_id NOT IN (SELECT member_id FROM hosp)),
init_nonip AS (SELECT d.member_id, e.fc, e.tc, e.claimid, e.alc_tr, e.op_tr, e.ot_tr, e.alc_rx, e.op_rx
    FROM den d JOIN eps e ON d.member_id = e.member_id
    WHERE coalesce(d.ip_stay, 0) <> 1 AND e.pf - d.iesd >= 0 AND e.pf - d.iesd < 14 AND e.claimid <> d.claimid
      AND ((d.alc_ep = 1 AND (e.alc_tr = 1 OR e.alc_rx = 1)) OR (d.op_ep = 1 AND (e.op_tr = 1 OR e.alc_rx = 1))
           OR (d.ot_ep = 1 AND e.ot_tr = 1))),
init_ip AS (SELECT member_id, iesd AS fc, iesd AS tc, claimid, alc_ep AS alc_tr, op_ep AS op_tr, ot_ep AS ot_tr,
    0 AS alc_rx, 0 AS op_rx FROM den WHERE ip_stay = 1),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY fc, tc DESC, claimid,
        alc_tr DESC, op_tr DESC, ot_tr DESC, alc_rx DESC, op_rx DESC) AS rn
    FROM (SELECT * FROM init_nonip UNION ALL SELECT * FROM init_ip)) WHERE rn = 1),
init AS (SELECT d.*, f.tc AS esd, f.alc_rx AS falc_rx, f.op_rx AS fop_rx,
    CASE WHEN f.member_id IS NOT NULL THEN 1 ELSE 0 END AS ni FROM den d LEFT JOIN firsts f ON d.member_id = f.member_id),
eng AS (SELECT i.member_id, sum(e.alc_rx) AS sar, sum(e.op_rx) AS sor, sum(e.alc_tr) AS sat, sum(e.op_tr) AS sot,
    sum(e.ot_tr) AS sxt FROM init i JOIN eps e ON i.member_id = e.member_id
    WHERE i.ni = 1 AND e.fc - i.esd > 0 AND e.fc - i.esd <= 34 GROUP BY i.member_id),
engr AS (SELECT i.member_id,
    CASE WHEN i.alc_ep = 1 THEN g.sat WHEN i.op_ep = 1 THEN g.sot WHEN i.ot_ep = 1 THEN g.sxt ELSE 0 END AS v,
    CASE WHEN i.alc_ep = 1 THEN g.sar WHEN i.op_ep = 1 THEN g.sor ELSE 0 END AS m,
    (coalesce(i.falc_rx, 0) <> 0 OR coalesce(i.fop_rx, 0) <> 0) AS rxe
    FROM init i LEFT JOIN eng g ON i.member_id = g.member_id WHERE i.ni = 1),
engf AS (SELECT member_id, CASE WHEN coalesce((rxe AND v >= 1 AND v + m >= 2) OR (NOT rxe AND (m >= 1 OR v >= 2)),
    false) THEN 1 ELSE 0 END AS ne FROM engr)"""


def aod_sql(which: str) -> str:
    if which == "init":
        body = f"SELECT member_id, {_result_cols(den='1', num='ni', actionable=ME)}, " \
               f"'No Qualifying Visit' AS comment FROM init"
    else:
        body = f"SELECT i.member_id, {_result_cols(den='1', num='coalesce(e.ne, 0)', actionable=ME)}, " \
               f"'No Qualifying Visit' AS comment FROM init i LEFT JOIN engf e ON i.member_id = e.member_id " \
               f"WHERE i.ni = 1"
    return _aod_core() + "\n" + body


# ---- combine ---------------------------------------------------------------------

_RESULT_SELECT = "member_id, denominator, numerator, comments, comp_quality_date_actionable"


def _measure_sqls() -> list[tuple[str, str]]:
    """(registry key, SQL returning the result columns) in registry order."""
    dental = prev_dental_sql()
    return [
        ("ED_Visits_MI", ed_mi_sql()),
        ("well_child_visits", well_child_sql()),
        ("prenatal_care", prenatal_sql("prenatal_care")),
        ("postpartum_care", prenatal_sql("postpartum_care")),
        ("aod_init", aod_sql("init")),
        ("aod_engage", aod_sql("engage")),
        ("DHS_assessments", custody_sql()),
        ("diabetes_oral_eval", oral_eval_sql()),
        ("prev_dental_1_to_5", f"SELECT * FROM ({dental}) WHERE measure = 'prev_dental_1_to_5'"),
        ("prev_dental_6_to_14", f"SELECT * FROM ({dental}) WHERE measure = 'prev_dental_6_to_14'"),
    ]


def _stack_body() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {_RESULT_SELECT}, '{k.upper()}' AS Measure_Abbreviation FROM ({q})" for k, q in _measure_sqls())


def stack_sql() -> str:
    return _stack_body()


def rate_summary_sql() -> str:
    return f"""SELECT Measure_Abbreviation, round(sum(numerator), 6) AS sum_numerator,
    round(sum(denominator), 6) AS sum_denominator,
    CASE WHEN sum(denominator) > 0 THEN round(coalesce(sum(numerator), 0) / sum(denominator), 4) ELSE 0.0 END
    AS measure_rate FROM ({_stack_body()}
    UNION ALL SELECT {_RESULT_SELECT}, 'ED_VISITS_ALL' FROM ({ed_all_sql()})) GROUP BY Measure_Abbreviation"""


def combined_sql() -> str:
    abbrev = ", ".join(f"('{a}')" for a, *_ in __import__("qmeasures.sources.refdata", fromlist=["x"]).ABBREVIATIONS)
    return f"""WITH stacked AS ({_stack_body()}),
ab(a) AS (VALUES {abbrev}),
roster AS (SELECT 'M' || CAST(c.c_custkey // 5 AS VARCHAR) AS member_id, min(n.n_name) AS mem_report_hier_1
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1)
SELECT s.member_id, s.Measure_Abbreviation, s.denominator AS comp_quality_denominator,
    s.numerator AS comp_quality_numerator, s.comments AS comp_quality_comments, s.comp_quality_date_actionable,
    r.mem_report_hier_1, ab.a AS comp_quality_short, CAST(NULL AS DATE) AS comp_quality_date_last
FROM stacked s JOIN roster r ON s.member_id = r.member_id LEFT JOIN ab ON upper(ab.a) = s.Measure_Abbreviation"""
