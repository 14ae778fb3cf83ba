"""Column builders (no Python UDFs)."""

from qmeasures.functions.codes import claims_filter, flag, code_set  # noqa: F401
from qmeasures.functions.dates import D, age_years, in_range  # noqa: F401
from qmeasures.functions.text import mmddyyyy, percent0  # noqa: F401
