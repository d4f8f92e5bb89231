"""Text forms of group keys.

A sketch is keyed by text.  Every part is cast with Spark's own
``cast(.. as string)`` -- the same text is produced when a key is inserted and
when it is looked up -- and a null part becomes ``__NULL__`` so that
``('a', null)`` and ``(null, 'a')`` stay apart (plain ``concat_ws`` would skip
the null and merge them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import KEY_DELIMITER, NULL_KEY_TEXT

ColumnLike = str | Column


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_part_text(c: ColumnLike) -> Column:
    """One key part as text, null-safe."""
    return F.coalesce(as_column(c).cast("string"), F.lit(NULL_KEY_TEXT))


def key_text(cols: Sequence[ColumnLike], delimiter: str = KEY_DELIMITER) -> Column:
    """Composite key text ``part1|part2|...`` with null parts spelled out."""
    parts = [key_part_text(c) for c in cols]
    if len(parts) == 1:
        return parts[0]
    return F.concat_ws(delimiter, *parts)


def value_columns(df: DataFrame, cols: Sequence[ColumnLike]) -> list[Column]:
    """Key columns of ``df`` as grouping sees them: a floating-point ``-0.0``
    becomes ``0.0`` (``groupBy`` treats them as one key, their texts differ).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in cols:
        col = as_column(c)
        if isinstance(c, str) and isinstance(types.get(c), (T.DoubleType, T.FloatType)):
            col = F.when(col == 0.0, F.lit(0.0).cast(types[c])).otherwise(col)
        out.append(col)
    return out


def seeded(text: Column, seed: int) -> Column:
    """Prefix a key text with ``<seed>:`` so that each seed gives new hashes."""
    return F.concat(F.lit(f"{seed}:"), text)
