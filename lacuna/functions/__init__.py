from lacuna.functions.columns import (
    clean, is_numeric, is_string, numeric_columns, string_columns, resolve_columns,
    pattern_bits, as_double,
)
from lacuna.functions.hashing import (
    full_hash, full_hash_sql, missing_at, missing_flag, missing_flag_sql,
    unit_uniform, gaussian_noise, gaussian_noise_sql,
)
from lacuna.functions.ranking import average_rank

__all__ = [
    "clean", "is_numeric", "is_string", "numeric_columns", "string_columns",
    "resolve_columns", "pattern_bits", "as_double", "full_hash",
    "full_hash_sql", "missing_at", "missing_flag", "missing_flag_sql", "unit_uniform",
    "gaussian_noise", "gaussian_noise_sql", "average_rank",
]
