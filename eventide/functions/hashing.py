"""The string hash used by the bitmap distinct count.

A polynomial hash over the characters of the value's decimal text, base 61,
reduced to the low 29 bits.  Reducing after every step gives the same low bits
as a 64-bit overflowing computation, and never overflows (ANSI mode safe).
The result is an offset into a 2^29-bit bitmap per window.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same offsets:
# base 61, bitmap of 2^29 bits (mask 2^29 - 1).
HASH_BASE = 61
BITMAP_BITS = 1 << 29


def poly_hash(value: str | Column, base: int = HASH_BASE, bits: int = BITMAP_BITS,
              integral: bool = False) -> Column:
    """``(sum(c_i * base^(n-1-i))) mod bits`` over the characters of ``cast(value as string)``.

    ``bits`` must be a power of two.  Strings: a higher-order ``aggregate`` over the
    characters.  ``integral=True`` (BIGINT / INT values): the same number from the
    decimal digits with plain BIGINT arithmetic, which whole-stage codegen compiles.
    """
    if bits & (bits - 1):
        raise ValueError("bits must be a power of two")
    v = F.col(value) if isinstance(value, str) else value
    if integral:
        return _poly_hash_digits(v.cast("long"), base, bits)
    chars = F.split(v.cast("string"), "")
    mask = F.lit(bits - 1).cast("long")
    return F.aggregate(chars, F.lit(0).cast("long"),
                       lambda acc, c: (acc * F.lit(base) + F.ascii(c)).bitwiseAND(mask))


def _poly_hash_digits(n: Column, base: int, bits: int) -> Column:
    """Base-``base`` hash of the decimal text of a BIGINT without building the text.

    Digit j (from the right) times 10^j is ``n % 10^(j+1) - n % 10^j``; that value and
    10^j are exact doubles (10^j = 5^j * 2^j with 5^j < 2^53), so the division is exact.
    Digit j weighs ``base^j``, a leading '-' weighs ``base^length``.  No abs() of ``n``,
    so the smallest BIGINT is fine.
    """
    powers = [pow(base, j, bits) for j in range(21)]
    total = F.lit(0).cast("long")
    length = F.lit(1).cast("long")
    for j in range(19):
        upper = n if j == 18 else n % F.lit(10 ** (j + 1))
        scaled = upper if j == 0 else upper - n % F.lit(10 ** j)
        digit = F.abs(scaled if j == 0 else (scaled / F.lit(10 ** j)).cast("long"))
        present = F.lit(True) if j == 0 else ((n >= F.lit(10 ** j)) | (n <= F.lit(-(10 ** j))))
        total = total + F.when(present, (F.lit(48) + digit) * F.lit(powers[j]).cast("long")).otherwise(F.lit(0))
        if j:
            length = length + present.cast("long")
    sign = F.when(n < 0, F.lit(45).cast("long") * F.element_at(
        F.array(*[F.lit(p).cast("long") for p in powers]), (length + 1).cast("int"))).otherwise(F.lit(0))
    return (total + sign).cast("long").bitwiseAND(F.lit(bits - 1).cast("long"))
