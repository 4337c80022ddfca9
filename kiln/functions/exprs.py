"""Column expressions shared by several operators.

All of them are built-in Spark expressions, so they stay inside
whole-stage code generation and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

# The modulus and the multipliers of the key-hash split and of
# the fold assignment. Both engines (Spark, DuckDB) compute the same
# integer arithmetic, so a split is reproducible on any partitioning.
SPLIT_MODULUS = 10007
SPLIT_MULTIPLIER = 7919
FOLD_MULTIPLIER = 6007


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bucket(key, seed: int, multiplier: int, integral: bool) -> Column:
    k = col_of(key)
    if integral:
        # reduced first, so that no key is too large; only the key modulo the
        # modulus matters, so keys that step by it all get one bucket
        b = F.pmod(F.pmod(k.cast("long"), F.lit(SPLIT_MODULUS)) * F.lit(multiplier) + F.lit(seed), F.lit(SPLIT_MODULUS))
        # a null key has a bucket too (that of key 0), so no row is in neither part
        return F.coalesce(b, F.pmod(F.lit(seed), F.lit(SPLIT_MODULUS)))
    # Any other key type: a 64-bit hash of the key and the seed (a null key hashes to the seed's own bucket).
    return F.pmod(F.xxhash64(k, F.lit(seed) + F.lit(multiplier)), F.lit(SPLIT_MODULUS))


def split_bucket(key, seed: int = 42, integral: bool = True) -> Column:
    """Bucket in [0, 10007) that decides train vs test for a row."""
    return _bucket(key, seed, SPLIT_MULTIPLIER, integral)


def split_threshold(ratio: float) -> int:
    return int(round(ratio * SPLIT_MODULUS))


def fold_of(key, k: int = 3, seed: int = 42, integral: bool = True) -> Column:
    """Fold number in [0, k) from the key; independent of the split bucket."""
    b = _bucket(key, seed, FOLD_MULTIPLIER, integral)
    return F.floor(b * F.lit(k) / F.lit(SPLIT_MODULUS)).cast("int")


def is_integral(df, key: str) -> bool:
    return isinstance(df.schema[key].dataType, IntegralType)


def within_tolerance(pred, actual, tol: float = 0.1) -> Column:
    """|pred - actual| / actual < tol; null when actual is 0 or null."""
    a = col_of(actual)
    return F.try_divide(F.abs(col_of(pred) - a), a) < F.lit(tol)


def interleave_bits(buckets: list[Column], bits: int) -> Column:
    """Z-order value: bit b of bucket i goes to position b * n + i."""
    n = len(buckets)
    z = F.lit(0).cast("long")
    for b in range(bits):
        for i, c in enumerate(buckets):
            bit = F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, b * n + i))
    return z


def bucket_by_cuts(c, cuts, strict: bool = False) -> Column:
    """Number of cut points <= value, or < value if ``strict`` (0..len(cuts));
    null stays null."""
    x = col_of(c)
    cuts = sorted(set(float(v) for v in cuts))
    if not cuts:
        return F.when(x.isNull(), None).otherwise(F.lit(0))
    # Binary search as nested CASE: depth log2(len(cuts)), all JVM-side.
    def search(lo: int, hi: int) -> Column:
        # result in [lo, hi]: number of cuts <= x, knowing cuts[lo-1] <= x < cuts[hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        over = x > F.lit(cuts[mid - 1]) if strict else x >= F.lit(cuts[mid - 1])
        return F.when(over, search(mid, hi)).otherwise(search(lo, mid - 1))
    return F.when(x.isNull(), None).otherwise(search(0, len(cuts)))
