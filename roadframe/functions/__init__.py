"""Column-expression builders.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen; no Python UDFs.
"""

from roadframe.functions.cleaning import (  # noqa: F401
    canonical_code, clip, hour_from_hhmm, integral_or_null, nonzero_flag,
    safe_date, sentinel_to_null, strip_to_long, to_number, weekday_name,
)
from roadframe.functions.flags import (  # noqa: F401
    any_in, equals_flag, flag_columns, other_involved, single_in,
)
from roadframe.functions.keys import pad_code  # noqa: F401
from roadframe.functions.recode import (  # noqa: F401
    collapse_target, recode, recode_columns,
)
