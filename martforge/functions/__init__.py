from martforge.functions.codes import classify, code_map, decode_codes
from martforge.functions.columns import (
    any_nonzero,
    fallback_text,
    is_set,
    is_unset,
    name_matches_any,
    not_flagged,
    safe_div,
    sap_date,
    strip_leading_zeros,
    yyyymmdd,
    zero_if_null,
)

__all__ = [
    "any_nonzero", "classify", "code_map", "decode_codes", "fallback_text", "is_set", "is_unset",
    "name_matches_any", "not_flagged", "safe_div", "sap_date", "strip_leading_zeros", "yyyymmdd",
    "zero_if_null",
]
