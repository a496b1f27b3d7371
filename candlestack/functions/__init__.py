"""Column-expression helpers (all built-in Spark functions, JVM side)."""

from candlestack.functions.dates import (epoch_millis_text, month_label, period_start,
                                         quarter_label, year_of)
from candlestack.functions.numeric import (nan_to_null, round_doubles, safe_div,
                                           sqrt_const)

__all__ = ["epoch_millis_text", "month_label", "quarter_label", "year_of", "period_start", "nan_to_null",
           "round_doubles", "safe_div", "sqrt_const"]
