"""The claims data model a measure run reads.

Every table is a DataFrame; optional tables may be ``None``.  A table given as
:class:`Later` is built when a measure first reads it.

* ``member``          member_id, dob  (duplicates are tolerated and collapsed)
* ``member_time``     member_id, date_start, date_end [, cover_medical]   (inclusive spans)
* ``member_months``   member_id, elig_month, memmos, cover_medical
* ``outclaims``       medical claim lines: member_id, claimid, prm_line, prm_fromdate,
                      prm_todate, fromdate, prm_fromdate_case, prm_todate_case, hcpcs,
                      revcode, pos, modifier, modifier2, icdversion, icddiag1.., icdproc1..,
                      prm_denied_yn
* ``outpharmacy``     member_id, claimid, prm_fromdate, ndc
* ``inpdental``       member_id, claimid, fromdate, hcpcs, providerid, tooth, ...
* ``providers``       prv_id, prv_taxonomy_cd
* ``dental_taxonomy`` taxonomy_code
* ``foster_care``     member_id, report_date, dob, branch_code, eligibility_effective_date
* ``predictions``     member_id, er_visits_pred_prob
* ``oha_codes`` / ``hedis_codes`` / ``medications``  code tables
* ``components``      measure, component, source ('hedis' | 'medications'), from the
                      mapping files (see :mod:`qmeasures.sources.mappings`)
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, functions as F

from qmeasures.operators.flagged import FlagRequest, flag_lines, flag_reader
from qmeasures.operators.reuse import materialize

_COMPONENT_CACHE: dict = {}
_MEMO_LOCK = threading.Lock()


class Later:
    """A table that is built when it is first read."""

    def __init__(self, build: Callable[[], DataFrame]):
        self._build, self._lock, self._table = build, threading.Lock(), None

    def __call__(self) -> DataFrame:
        with self._lock:  # measures run side by side
            if self._table is None:
                self._table = self._build()
            return self._table


@dataclass
class ClaimsInputs:
    member: DataFrame
    outclaims: DataFrame
    member_time: DataFrame | None = None
    member_months: DataFrame | None = None
    outpharmacy: DataFrame | None = None
    inpdental: DataFrame | None = None
    providers: DataFrame | None = None
    dental_taxonomy: DataFrame | None = None
    foster_care: DataFrame | None = None
    predictions: DataFrame | None = None
    oha_codes: DataFrame | None = None
    hedis_codes: DataFrame | None = None
    medications: DataFrame | None = None
    components: DataFrame | None = None

    def __getattribute__(self, name):
        value = object.__getattribute__(self, name)
        return value() if isinstance(value, Later) else value

    def with_(self, **kw) -> "ClaimsInputs":
        return ClaimsInputs(**{f.name: self.__dict__[f.name] for f in fields(self)} | kw)

    def memo(self, key, build):
        """Share an intermediate between measures run on the same inputs (e.g. the
        prenatal and postpartum measures read one delivery plan)."""
        with _MEMO_LOCK:
            store = self.__dict__.setdefault("_memo", {})
            lock = self.__dict__.setdefault("_memo_locks", {}).setdefault(key, threading.RLock())
        with lock:  # measures run side by side: one of them builds, the others wait
            if key not in store:
                store[key] = build()
            return store[key]

    def forget(self) -> None:
        """Drop shared intermediates (after their files are released)."""
        self.__dict__.pop("_memo", None)
        self.__dict__.pop("_flags", None)

    #: line columns that measures read beside flags
    LINE_COLUMNS = ("member_id", "claimid", "prm_line", "prm_fromdate", "prm_todate", "fromdate", "prm_fromdate_case",
                    "prm_todate_case", "icdversion")

    #: flags that the plans of a measure test in the written lines themselves
    PLANNED_FLAGS = 6

    def request(self, source: str, measure: str, component: str, **how) -> FlagRequest:
        return FlagRequest(source, measure, component, **how)

    def flagged_lines(self, requests, write_where: Column | None = None) -> DataFrame:
        """Medical claim lines with a boolean column for each request (``FlagRequest.name``), at least one of
        whose codes a line carries.

        If the run has prepared the flags of all its measures (:meth:`prepare_flags`), all of them read what was
        written; a measure with more than ``PLANNED_FLAGS`` flags gets its own lines written once more, with its
        flags as columns, so that no plan tests them.  Otherwise the frame is lazy, and a measure's own filters reach the scan; a measure that
        reads many flags several times gives its filter as ``write_where``, and gets the lines that pass
        it written once.  Either way the measure applies its filters itself.
        """
        wanted = sorted(set(requests), key=lambda r: r.name)
        shared = self.__dict__.get("_flags")
        if shared is not None and set(wanted) <= shared[0]:
            if len(wanted) <= self.PLANNED_FLAGS:
                return shared[1](wanted)

            def own() -> DataFrame:
                lines = shared[1](wanted)
                return materialize(lines if write_where is None else lines.filter(write_where))
            return self.memo(("shared flags", tuple(wanted), str(write_where)), own)
        if write_where is None:
            return self.memo(("flagged", tuple(wanted)), lambda: self._flag(self.outclaims, wanted))
        return self.memo(("flagged", tuple(wanted), str(write_where)),
                         lambda: self._flag(self.outclaims.filter(write_where), wanted, write=materialize))

    def _code_tables(self) -> dict[str, DataFrame]:
        return {"oha": self.oha_codes, "hedis": self.hedis_codes, "medications": self.medications}

    def _flag(self, claims: DataFrame, wanted, write=None) -> DataFrame:
        return flag_lines(claims, self._code_tables(), wanted, self.LINE_COLUMNS, write=write)

    def prepare_flags(self, requests) -> None:
        """One scan of the code columns for all these requests, written; later calls read the result."""
        shared = self.__dict__.get("_flags")
        if shared is None or not set(requests) <= shared[0]:
            self.__dict__["_flags"] = (frozenset(requests), flag_reader(
                self.outclaims, self._code_tables(), requests, self.LINE_COLUMNS, write=materialize))

    def members(self) -> DataFrame:
        """One row per member (duplicate roster rows collapse; earliest dob wins)."""
        return self.member.groupBy("member_id").agg(F.min("dob").alias("dob"))

    def component_list(self, measure: str, exclude=(), source: str | None = None) -> list[tuple[str, str]]:
        """(component, source) pairs mapped to ``measure``, in mapping order.

        The mapping is a reference dimension of a few dozen rows.
        """
        if self.components is None:
            raise ValueError("no component mapping supplied")
        skip = {c.lower() for c in exclude}
        key = (id(self.components), measure.lower())
        hit = _COMPONENT_CACHE.get(key)
        if hit is None or hit[0] is not self.components:
            rows = (self.components
                    .filter(F.lower("measure") == measure.lower())
                    .select("component", "source", "ordinal")
                    .collect())
            _COMPONENT_CACHE[key] = hit = (self.components, rows)
        rows = hit[1]
        rows = sorted(rows, key=lambda r: r["ordinal"])
        out = []
        for r in rows:
            if r["component"].lower() in skip:
                continue
            if source is not None and r["source"] != source:
                continue
            out.append((r["component"], r["source"]))
        return out

    def codes_for(self, source: str) -> DataFrame:
        return self.medications if source == "medications" else self.hedis_codes
