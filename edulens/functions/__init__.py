"""Column-level functions (JVM-side, codegen friendly)."""

from edulens.functions.cleaning import (  # noqa: F401
    clean_int, clean_real, clean_digit_text, is_digit_text, year_int, year_of, year_equals, norm_label, to_number,
)
from edulens.functions.predicates import (  # noqa: F401
    label_startswith, label_contains, not_like_ci, in_values, positive, flag_is,
)
from edulens.functions.formatting import fixed6, now_text, parse_ts  # noqa: F401
