"""Order-free randomness: everything random is a function of (key, seed), so a retry gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def tie_key(key: Column | str) -> Column:
    """Uniform, deterministic tie-break for rows that share a sort value."""
    return F.md5(_col(key).cast("string"))


def hash_int(key: Column | str, seed: int | str) -> Column:
    """First 32 bits of md5(key|seed) as a long."""
    digest = F.md5(F.concat_ws("|", _col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_unit(key: Column | str, seed: int | str) -> Column:
    """Uniform number in [0, 1)."""
    return hash_int(key, seed) / F.lit(4294967296.0)


def hash_normal(key: Column | str, seed: int | str) -> Column:
    """Standard normal number from two uniform ones."""
    u = (hash_int(key, f"{seed}a") + F.lit(1)) / F.lit(4294967297.0)
    v = hash_unit(key, f"{seed}b")
    return F.sqrt(-2.0 * F.log(u)) * F.cos(v * F.lit(6.283185307179586))


def fold_of(key: Column | str, folds: int, seed: int | str = 42) -> Column:
    """Cross-validation fold of a row; needs no sort and no count."""
    return (hash_int(key, seed) % F.lit(folds)).cast("int")


def experiment_arm(user: Column | str, treatment_share: float) -> Column:
    """md5(user) as a 128-bit number modulo 100, compared with the treatment share.

    The digest is read as four 32-bit words; 2**32 leaves remainder 96 modulo 100.
    """
    digest = F.md5(_col(user).cast("string"))
    rest = F.lit(0).cast("long")
    for start in (1, 9, 17, 25):
        word = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
        rest = (rest * F.lit(96) + word) % F.lit(100)
    return F.when(rest < F.lit(treatment_share * 100), F.lit("treatment")).otherwise(F.lit("control"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
