"""Portable hashes built from ``md5``.

Both hashes below are plain column expressions (they stay inside whole-stage
codegen) and can be written the same way in any SQL engine that has ``md5``,
which is what lets a sample or a sketch be checked row for row against an
independent engine.

* :func:`rank_hash` -- the 32-digit lowercase hex digest itself.  Fixed-width
  lowercase hex sorts as text exactly as the 128-bit number it spells, so
  ranks are ordered and thresholded as strings, with no base conversion;
  :func:`rank_threshold` spells a 60-bit threshold as such a prefix.
* :func:`bucket` -- ``(h1 + d * h2) mod width`` for row ``d`` of a Count-Min
  sketch (Cormode & Muthukrishnan 2005) by double hashing (Kirsch &
  Mitzenmacher 2006).  ``h1``/``h2`` are the upper 32 and lower 28 bits of
  the digest's first 60 bits -- one base conversion per key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANK_BITS = 60
RANK_SPACE = 1 << RANK_BITS


def hex_digits_to_long(hex_text: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(hex_text, start, length), 16, 10).cast("bigint")


def rank_hash(text: Column) -> Column:
    """Uniform rank of a text: its md5 digest as 32 lowercase hex digits."""
    return F.md5(text)


def rank_threshold(threshold: int) -> str:
    """Hex text ``t`` such that ``rank < t`` iff the rank's first 60 bits are
    ``< threshold`` (``threshold`` in ``[0, 2**60]``)."""
    if threshold >= RANK_SPACE:
        return "g"  # above every hex digit: keeps all ranks
    return format(threshold, "015x")


H2_BITS = 28


def digest_bits(text: Column) -> Column:
    """The first 60 bits of the md5 digest of ``text`` as a bigint."""
    return hex_digits_to_long(F.md5(text), 1, 15)


def split_bits(bits: Column) -> tuple[Column, Column]:
    """``(h1, h2)`` from 60 digest bits: upper 32 bits, lower 28 bits."""
    return F.shiftright(bits, H2_BITS), bits.bitwiseAND(F.lit((1 << H2_BITS) - 1))


def digest_pair(text: Column) -> tuple[Column, Column]:
    """``(h1, h2)``: two independent values of one digest (32 and 28 bits)."""
    return split_bits(digest_bits(text))


def bucket(h1: Column, h2: Column, row: Column, width: int) -> Column:
    """Bucket of sketch row ``row`` for a key with digest pair ``(h1, h2)``."""
    return F.pmod(h1 + row * h2, F.lit(width)).cast("int")
