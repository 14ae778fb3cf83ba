"""Measure registry: standard measures, opt-in measures and custom measures.

A measure is ``fn(inputs, params) -> DataFrame`` returning at least the
``RESULT_SCHEMA`` columns (member_id, denominator, numerator, comments,
comp_quality_date_actionable).  Measures are keyed by their published abbreviation;
registering an existing key replaces it (custom measures run after the standard ones
and may overwrite a result); names compare case-insensitively.  Running a measure writes
the intermediates it shares between branches to the checkpoint folder at once; the
result itself is a lazy DataFrame over them.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import DataFrame, types as T

from qmeasures.inputs import ClaimsInputs
from qmeasures.operators.reuse import materialize
from qmeasures.params import MeasureParams
from qmeasures.schemas import RESULT_SCHEMA, to_result

MeasureFn = Callable[[ClaimsInputs, MeasureParams], DataFrame]


#: Size of the claim lines, as the optimizer estimates it, from which one pass is shared by all measures.
SHARED_FROM_BYTES = 4 << 30
SHARED_SIDE_BY_SIDE = 1


def _plan_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


class SchemaMismatch(ValueError):
    pass


def check_result_schema(name: str, df: DataFrame) -> None:
    have = {c.lower() for c in df.columns}
    missing = [f.name for f in RESULT_SCHEMA.fields if f.name.lower() not in have and f.name != "comments"]
    if missing:
        raise SchemaMismatch(f"measure {name!r} lacks result columns {missing}")
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    wrong = [f"{f.name} is {kinds[f.name.lower()].simpleString()}" for f in RESULT_SCHEMA.fields
             if f.name.lower() in kinds and not _fits(f.name, kinds[f.name.lower()])]
    if wrong:
        raise SchemaMismatch(f"measure {name!r}: {', '.join(wrong)}")


def _fits(column: str, kind: T.DataType) -> bool:
    if isinstance(kind, T.NullType):
        return column not in ("member_id", "numerator", "denominator")
    allowed = {"member_id": (T.StringType,), "comments": (T.StringType,), "comp_quality_date_actionable": (T.DateType,)}
    return isinstance(kind, allowed.get(column, (T.NumericType,)))


class MeasureRegistry:
    def __init__(self):
        self._measures: "OrderedDict[str, MeasureFn]" = OrderedDict()
        self._requests: dict[str, Callable[[ClaimsInputs], list]] = {}
        self._optional: set[str] = set()
        self._enabled: set[str] = set()

    def register(self, name: str, fn: MeasureFn, optional: bool = False, requests=None) -> "MeasureRegistry":
        """``requests(inputs)`` lists the claim line flags that the measure reads (:class:`FlagRequest`)."""
        # a later registration overrides (and runs later); its spelling of the name is used
        for old in [n for n in self._measures if n.upper() == name.upper()]:
            del self._measures[old]
            self._requests.pop(old, None)
        self._measures[name] = fn
        if requests is not None:
            self._requests[name] = requests
        (self._optional.add if optional else self._optional.discard)(name.upper())
        return self

    def enable(self, *names: str) -> "MeasureRegistry":
        known = {n.upper() for n in self._measures}
        unknown = [n for n in names if n.upper() not in known]
        if unknown:
            raise KeyError(f"unknown measures {unknown}")
        self._enabled.update(n.upper() for n in names)
        return self

    def _has_inputs(self, name: str, inputs: ClaimsInputs) -> bool:
        """Optional measures without their table give an empty result and read no claims."""
        needs = {"DHS_ASSESSMENTS": "foster_care", "DIABETES_ORAL_EVAL": "inpdental"}
        return getattr(inputs, needs.get(name.upper(), "outclaims")) is not None

    def active(self) -> list[str]:
        return [n for n in self._measures if n.upper() not in self._optional or n.upper() in self._enabled]

    def run(self, inputs: ClaimsInputs, params: MeasureParams, side_by_side: int = 5,
            shared_pass: bool | None = None) -> "OrderedDict[str, DataFrame]":
        """Results by name, in registration order.

        Measures are independent of each other, so the jobs of up to ``side_by_side`` of them
        are submitted to Spark at the same time.  With ``shared_pass`` the code columns of the claim
        lines are read once for all active measures before that; without it each measure reads
        them, with its own date filter.  Left open, the shared pass is taken from
        ``SHARED_FROM_BYTES`` of claims on: below that, side-by-side scans end sooner.  With it, at most
        ``SHARED_SIDE_BY_SIDE`` measures run at once and their results are written, which bounds the driver's
        memory.
        """
        names = self.active()
        readers = [n for n in names if n in self._requests and self._has_inputs(n, inputs)]
        if shared_pass is None:
            shared_pass = bool(readers) and _plan_bytes(inputs.outclaims) >= SHARED_FROM_BYTES
        if shared_pass and readers:
            inputs.prepare_flags({r for n in readers for r in self._requests[n](inputs)})

        def one(name: str) -> DataFrame:
            df = self._measures[name](inputs, params)
            check_result_schema(name, df)
            df = to_result(df) if "comments" in df.columns else to_result(df, comments_col="_none_")
            # ten measures in one plan start all their exchanges at once, each with a thread of the driver
            return materialize(df) if shared_pass else df
        if shared_pass:
            side_by_side = min(side_by_side, SHARED_SIDE_BY_SIDE)
        with ThreadPoolExecutor(max_workers=max(1, side_by_side)) as pool:
            # each thread runs in a copy of the caller's context: its run scope gets the intermediates
            jobs = [pool.submit(copy_context().run, one, n) for n in names]
            return OrderedDict((n, job.result()) for n, job in zip(names, jobs))


def default_registry() -> MeasureRegistry:
    """Standard measures, plus the opt-in custody and dental measures (call ``enable``)."""
    from qmeasures.measures import aod, custody, dental, ed_visits, oral_eval, prenatal, well_child
    reg = MeasureRegistry()
    reg.register("ED_Visits_MI", ed_visits.ed_visits_mi, requests=ed_visits.requests_mi)
    reg.register("well_child_visits", well_child.well_child_visits, requests=well_child.requests)
    reg.register("prenatal_care", prenatal.prenatal_care, requests=prenatal.requests)
    reg.register("postpartum_care", prenatal.postpartum_care, requests=prenatal.requests)
    reg.register("aod_init", aod.aod_init, requests=aod.requests)
    reg.register("aod_engage", aod.aod_engage, requests=aod.requests)
    reg.register("DHS_assessments", custody.dhs_assessments, optional=True, requests=custody.requests)
    reg.register("diabetes_oral_eval", oral_eval.oral_eval, optional=True, requests=oral_eval.requests)
    reg.register("prev_dental_1_to_5", dental.prev_dental_1_to_5, optional=True)
    reg.register("prev_dental_6_to_14", dental.prev_dental_6_to_14, optional=True)
    return reg
