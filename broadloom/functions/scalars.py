"""Scalar expressions."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_month_name(column: str, iso: str = "yyyy-MM-dd") -> Column:
    """Date from ``31-OCT-2019`` text; text already in ISO form passes through."""
    named = F.try_to_timestamp(F.col(column), F.lit("dd-MMM-yyyy"))
    plain = F.try_to_timestamp(F.col(column), F.lit(iso))
    return F.coalesce(named, plain).cast("date")


def csv_fields(column: str, fields: dict[str, tuple[int, str]], separator: str = ",") -> list[Column]:
    """Typed fields picked by position from separated text; bad values are NULL."""
    parts = F.split(F.col(column), separator)
    return [F.get(parts, F.lit(i)).try_cast(kind).alias(name) for name, (i, kind) in fields.items()]


def record_key(column: str, separator: str = ",") -> Column:
    """First field of a separated message."""
    return F.substring_index(F.col(column), separator, 1)


def without_trailing(column: str, separator: str = ",") -> Column:
    """The message without one trailing separator."""
    return F.regexp_replace(F.col(column), f"{separator}$", "")


def joined_message(columns: Sequence[str], separator: str = ",") -> Column:
    """Columns rendered as one separated message."""
    return F.concat_ws(separator, *[F.col(c).cast("string") for c in columns])


def variant_symbol(column: str, seed_by: Sequence[str]) -> Column:
    """Symbol with one letter lower-cased and a digit appended.

    Letter and digit are drawn from a hash of ``seed_by``: they vary between
    rows but never between two runs of a task.
    """
    h = F.xxhash64(*[F.col(c) for c in seed_by])
    at = (F.pmod(h, F.length(column)) + 1).cast("int")
    digit = F.pmod(F.shiftright(h, 8), F.lit(10)).cast("string")
    letter = F.lower(F.substring(F.col(column), at, F.lit(1)))
    return F.concat(
        F.substring(F.col(column), F.lit(1), at - 1), letter, F.substring(F.col(column), at + 1, F.length(column)), digit
    )


#: Bases for which the strong-pseudoprime test is exact on all 64-bit numbers.
_PRIME_BASES = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)


def _prime(n: int | None) -> bool | None:
    if n is None or n < 2:
        return None if n is None else False
    for p in _PRIME_BASES:
        if n % p == 0:
            return n == p
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in _PRIME_BASES:
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def is_prime(column: str) -> Column:
    """Whether a whole number is prime, by strong-pseudoprime tests; NULL for NULL."""
    @F.arrow_udf("boolean")
    def test(numbers: pa.Array) -> pa.Array:
        return pa.array([_prime(n) for n in numbers.to_pylist()], pa.bool_())

    return test(F.col(column).cast("long"))


def hot_index(columns: Sequence[str]) -> Column:
    """Position of the first 1 among indicator columns, from 0; NULL if none."""
    return F.nullif(F.array_position(F.array(*[F.col(c).cast("int") for c in columns]), F.lit(1)), F.lit(0)) - 1
