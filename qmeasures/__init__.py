"""Health-plan quality measures as Spark DataFrame plans.

Sub-packages:

* ``functions``  – Column builders: code-set predicates, date/age helpers, text formats.
* ``operators``  – re-usable DataFrame operators (eligibility gaps, coverage islands,
  anchored grouping, flag roll-ups, first-row picks, windowed joins).
* ``sources``    – reference-data ingest (schema CSVs, strict CSV scans, mapping files,
  value-set XML) and the adapter that derives the claims model from the test tables.
* ``measures``   – the ready measures, each ``(inputs, params) -> DataFrame``.
* ``plans``      – registry of measures, combine/publish, rate summary, validators.
"""

from qmeasures.params import MeasureParams  # noqa: F401
from qmeasures.schemas import RESULT_SCHEMA  # noqa: F401
