"""Column expressions used by the operators (all JVM-side, codegen friendly)."""

from clinlake.functions.scalar import (
    argmax_array,
    case_bucket,
    hash_bucket,
    hash_order_key,
    is_neither,
    null_if_sentinel,
    ratio_round,
    round_exact,
    row_width,
    text_match_any,
    to_int,
)

__all__ = [
    "argmax_array",
    "case_bucket",
    "hash_bucket",
    "hash_order_key",
    "is_neither",
    "null_if_sentinel",
    "ratio_round",
    "round_exact",
    "row_width",
    "text_match_any",
    "to_int",
]
