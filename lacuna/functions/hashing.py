"""Portable hashing for masks and noise.

Spark's ``rand()`` and ``xxhash64`` have no twin in other engines, so a cell's hash is the first
60 bits of an MD5 over ``salt|id``, which every SQL engine evaluates alike.  It depends only on
(row id, salt), never on partitioning or task retries, so a lost executor recomputes the same
holes.  Ids of any type are hashed by their text: there is no period, no overflow and no limit
on their size.  Salts are integers or strings; two salts share nothing unless they are equal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 60
SPACE = 1 << BITS


def _md5_key(id_col: Column | str, salt) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{salt}|"), F.coalesce(c.cast("string"), F.lit("")).cast("string")).cast("binary"))


def full_hash(id_col: Column | str, salt) -> Column:
    """h(id, salt), uniform in [0, 2^60)."""
    return F.conv(F.substring(_md5_key(id_col, salt), 1, BITS // 4), 16, 10).cast("long")


def full_hash_sql(id_expr: str, salt) -> str:
    return (f"CAST('0x' || substr(md5('{salt}|' || coalesce(CAST({id_expr} AS VARCHAR), '')), 1, {BITS // 4}) AS BIGINT)")


def rate_limit(rate: float) -> int:
    """Hashes below this value make up ``rate`` of all."""
    return min(SPACE, max(0, round(rate * SPACE)))


def missing_at(id_col: Column | str, salt, rate: float) -> Column:
    """``full_hash < rate_limit``, on the hexadecimal digits themselves (they sort as numbers)."""
    limit = rate_limit(rate)
    return F.lit(True) if limit == SPACE else _md5_key(id_col, salt) < F.lit(f"{limit:0{BITS // 4}x}")


def missing_flag(id_col: Column | str, salt, permille: float) -> Column:
    return missing_at(id_col, salt, permille / 1000)


def missing_flag_sql(id_expr: str, salt, permille: float) -> str:
    return f"({full_hash_sql(id_expr, salt)} < {rate_limit(permille / 1000)})"


def unit_uniform(id_col: Column | str, salt) -> Column:
    """A value in (0, 1)."""
    return (full_hash(id_col, salt).cast("double") + F.lit(0.5)) / F.lit(float(SPACE))


def _unit_uniform_sql(id_expr: str, salt) -> str:
    return f"((CAST({full_hash_sql(id_expr, salt)} AS DOUBLE) + 0.5) / {float(SPACE)!r}::DOUBLE)"


def gaussian_noise(id_col: Column | str, salt) -> Column:
    """Standard normal draw by Box-Muller on two hashed uniforms."""
    u1 = unit_uniform(id_col, salt)
    u2 = unit_uniform(id_col, f"{salt}|angle")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def gaussian_noise_sql(id_expr: str, salt) -> str:
    u1 = _unit_uniform_sql(id_expr, salt)
    u2 = _unit_uniform_sql(id_expr, f"{salt}|angle")
    return f"(sqrt(-2.0 * ln({u1})) * cos({2 * math.pi!r} * {u2}))"
