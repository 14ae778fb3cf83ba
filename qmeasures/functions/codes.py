"""Code-set predicates: a claim-line boolean built from a code table.

Rules (one code table row = measure, component, codesystem, code, grouping_id, diag_type):

* measure / component / codesystem compare case-insensitively;
* the codesystem picks the claim column (CPT/HCPCS/CDT -> ``hcpcs``, UBREV ->
  ``revcode``, POS -> ``pos``, MODIFIER -> ``modifier`` or ``modifier2``, ICD diag ->
  ``icddiag*`` by diag_type, ICD proc -> ``icdproc*``, NDC -> ``ndc``, TOOTH ->
  ``tooth``, UBTOB -> ``billtype``); a column the frame lacks never matches;
* rows without ``grouping_id`` are OR-ed; rows sharing a ``grouping_id`` need every
  codesystem of the group to match (OR within a codesystem), groups are OR-ed;
* ``diag_type`` Primary -> first diagnosis only, Secondary -> second and later,
  All / blank -> any position;
* the ICD version is not part of the predicate;
* the result is never NULL (missing claim values are "no match").

Code lists become hashed ``InSet`` literals (Catalyst switches to a hash set above
ten values), so the predicate stays inside whole-stage codegen and no join with the
code table is needed.  Only the slice of the code table for one component is read
on the driver; code tables are reference dimensions whose size does not grow with
the claims.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# FIXED VALUES — code systems that are listed in code tables but have no claim column.
_NO_CLAIM_COLUMN = {"SNOMEDCT", "LOINC", "RXNORM"}
# FIXED VALUES — ICD version text of each diagnosis code system.
_DIAG_VERSION = {"ICD9CM-DIAG": "09", "ICD10CM-DIAG": "10"}


class CodeTableError(ValueError):
    """A code table row that a predicate or lookup cannot use."""


_SINGLE_COLUMN = {
    "CPT": "hcpcs",
    "HCPCS": "hcpcs",
    "CDT": "hcpcs",
    "DENTAL": "hcpcs",
    "UBREV": "revcode",
    "POS": "pos",
    "NDC": "ndc",
    "TOOTH": "tooth",
    "UBTOB": "billtype",
}


def _numbered(columns, prefix: str) -> list[str]:
    pat = re.compile(rf"^{prefix}(\d+)$", re.IGNORECASE)
    found = [(int(m.group(1)), c) for c in columns if (m := pat.match(c))]
    return [c for _, c in sorted(found)]


@dataclass(frozen=True)
class CodeRow:
    codesystem: str
    code: str
    grouping_id: str | None
    diag_type: str | None
    copies: int = 1


def _blank_to_none(v):
    if v is None:
        return None
    v = str(v).strip()
    return v or None


_MEASURE_CACHE: dict = {}


def _measure_slice(codes: DataFrame, measure: str) -> dict:
    """component -> rows for one measure, read once per code table and measure.

    Only the measure's slice of the (reference-size) code table reaches the driver.
    """
    key = (id(codes), measure.strip().lower())
    hit = _MEASURE_CACHE.get(key)
    if hit is not None and hit[0] is codes:
        return hit[1]
    rows = (codes
            .filter(F.lower(F.trim("measure")) == measure.strip().lower())
            .select(F.lower(F.trim("component")).alias("component"), "codesystem", "code",
                    *[c if c in codes.columns else F.lit(None).cast("string").alias(c)
                      for c in ("grouping_id", "diag_type")])
            .groupBy("component", "codesystem", "code", "grouping_id", "diag_type")
            .agg(F.count(F.lit(1)).alias("copies"))
            .collect())
    by_comp = defaultdict(list)
    for r in rows:
        by_comp[r["component"]].append(
            CodeRow(str(r["codesystem"]).strip().upper(), str(r["code"]).strip(),
                    _blank_to_none(r["grouping_id"]), _blank_to_none(r["diag_type"]), r["copies"]))
    _MEASURE_CACHE[key] = (codes, dict(by_comp))
    return _MEASURE_CACHE[key][1]


def code_rows(codes: DataFrame, measure: str, component: str) -> list[CodeRow]:
    """The code table slice for one measure x component (case-insensitive)."""
    return list(_measure_slice(codes, measure).get(component.strip().lower(), []))


def _isin(col_name: str, values) -> Column:
    return F.coalesce(F.col(col_name).isin(sorted(values)), F.lit(False))


def _any_column_in(columns: list[str], values) -> Column:
    """Is the value of any of the columns in the set?

    A few columns are tested one by one.  Many (a claim line has 15 diagnoses and 15
    procedures) are tested as one array, so the generated code stays small enough for
    the JVM to compile whatever the number of components.
    """
    listed = sorted(values)
    if len(columns) <= 3:
        return _any([_isin(c, listed) for c in columns])
    return F.coalesce(F.exists(F.array(*columns), lambda code: code.isin(listed)), F.lit(False))


def _any(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, terms) if terms else F.lit(False)


def _all(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, terms) if terms else F.lit(False)


def _codesystem_term(codesystem: str, rows: list[CodeRow], columns) -> Column:
    cols = set(columns)
    cs = codesystem.upper()
    if cs in _SINGLE_COLUMN:
        target = _SINGLE_COLUMN[cs]
        return _isin(target, {r.code for r in rows}) if target in cols else F.lit(False)
    if cs == "MODIFIER":
        codes = {r.code for r in rows}
        return _any([_isin(c, codes) for c in ("modifier", "modifier2") if c in cols])
    if cs.endswith("-DIAG"):
        diags = _numbered(columns, "icddiag")
        by_type = defaultdict(set)
        for r in rows:
            by_type[(r.diag_type or "all").lower()].add(r.code)
        terms = []
        for dtype, codes in by_type.items():
            if dtype == "primary":
                targets = diags[:1]
            elif dtype == "secondary":
                targets = diags[1:]
            else:
                targets = diags
            if targets:
                terms.append(_any_column_in(targets, codes))
        return _any(terms)
    if cs.endswith("-PROC"):
        codes = {r.code for r in rows}
        procs = _numbered(columns, "icdproc")
        return _any_column_in(procs, codes) if procs else F.lit(False)
    if cs in _NO_CLAIM_COLUMN:
        return F.lit(False)
    raise CodeTableError(f"code system {codesystem!r} is not known")


def predicate_from_rows(rows: list[CodeRow], columns) -> Column:
    """Build the boolean Column from code rows against a frame's column list."""
    ungrouped = defaultdict(list)
    groups = defaultdict(lambda: defaultdict(list))
    for r in rows:
        if r.grouping_id is None:
            ungrouped[r.codesystem].append(r)
        else:
            groups[r.grouping_id][r.codesystem].append(r)
    terms = [_codesystem_term(cs, rs, columns) for cs, rs in sorted(ungrouped.items())]
    for gid in sorted(groups):
        terms.append(_all([_codesystem_term(cs, rs, columns)
                           for cs, rs in sorted(groups[gid].items())]))
    return _any(terms)


def claims_filter(codes: DataFrame, measure: str, component: str, frame) -> Column:
    """Boolean Column: does a line of ``frame`` match ``measure``/``component`` codes.

    ``frame`` is the DataFrame the predicate will be applied to (or its column list);
    it decides which diagnosis / procedure / modifier columns exist.
    """
    columns = frame.columns if isinstance(frame, DataFrame) else list(frame)
    return predicate_from_rows(code_rows(codes, measure, component), columns)


def flag(codes: DataFrame, measure: str, component: str, frame) -> Column:
    """The predicate as a 0/1 integer column named after the component."""
    return claims_filter(codes, measure, component, frame).cast("int").alias(component)


def code_set(codes: DataFrame, measure: str, component: str, codesystems=None) -> list[str]:
    """Plain list of codes for a component (optionally limited to code systems)."""
    wanted = {c.upper() for c in codesystems} if codesystems else None
    return sorted({r.code for r in code_rows(codes, measure, component)
                   if wanted is None or r.codesystem in wanted})


def versioned_diag_codes(codes: DataFrame, measure: str, component: str,
                         only: tuple[str, ...] | None = None) -> dict[str, list[str]]:
    """ICD version ('09' / '10') -> diagnosis codes of a lookup list.

    The key (code, version) must be unique: a repeated row raises.  ``only`` names the
    code systems the whole component may use; any other row raises instead of being
    left out.
    """
    rows = code_rows(codes, measure, component)
    if only is not None:
        wrong = sorted({r.codesystem for r in rows} - {c.upper() for c in only})
        if wrong:
            raise CodeTableError(f"{measure}/{component}: code systems {wrong} are not supported in this list")
    out: dict[str, list[str]] = {}
    for r in rows:
        if r.codesystem in _DIAG_VERSION:
            out.setdefault(_DIAG_VERSION[r.codesystem], []).extend([r.code] * r.copies)
    for version, found in out.items():
        if len(set(found)) < len(found):
            twice = sorted({c for c in found if found.count(c) > 1})
            raise CodeTableError(f"{measure}/{component}: version {version} lists {twice} more than once")
    return {v: sorted(c) for v, c in out.items()}


def any_versioned_diag(frame, by_version: dict[str, list[str]], version_col: str = "icdversion") -> Column:
    """True when any diagnosis of the line is in the list of the line's ICD version.

    This is the lookup form used for large diagnosis lists: the version is part of
    the key (unlike :func:`claims_filter`).  One hashed set per version and column; no
    key strings are built.
    """
    columns = frame.columns if isinstance(frame, DataFrame) else list(frame)
    diags = _numbered(columns, "icddiag")
    if not by_version or version_col not in columns:
        return F.lit(False)
    return _any([F.coalesce(F.col(version_col) == version, F.lit(False)) & _any_column_in(diags, listed)
                 for version, listed in sorted(by_version.items())])
