"""Fill-in-the-middle: a text is cut in three and its middle moved to the end.

The cut is one match of a pattern made for the row.  ``regexp_count`` gives the
number n of units (code points); two numbers from a hash of doc_id give the
ends a <= b of prefix and middle; the pattern

    (?s)\\A(.{a}+)(.{b-a}+)(.*+)\\z

captures prefix, middle and suffix with possessive counted groups, so the
matcher never steps back, and ``regexp_replace`` writes the captured parts in
the order of the row's form, in the same match:

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle
    plain  the text as it is

All of it is a narrow projection of built-in functions: no shuffle and no
Python, and a task holds a few copies of the text at hand.  ``regexp_count``
keeps every match until it has counted them, so units are counted by blocks of
:data:`BLOCK` first and then in the rest behind the blocks.

Defined results: null text counts as empty; an empty text, and one that holds a
marker itself, is plain; null doc_id is hashed as an empty name, equal rows get
equal cuts.  No row is dropped, an empty table gives an empty result, and columns
beside ``doc_id`` and ``text`` do not matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "."  # with (?s): one code point
BLOCK = 4096  # units counted as one match


@dataclass(frozen=True)
class Infilling:
    """Markers, shares in percent (``spm`` of the texts that are not plain) and the seed of the cuts."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    plain_percent: int = 10
    spm_percent: int = 20
    seed: int = 1

    def __post_init__(self) -> None:
        if len(set(self.markers)) < 3:
            raise ValueError("the markers must differ")
        for x in self.markers:
            for y in self.markers:
                meets = any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y)) + (x != y)))
                if not x or meets or (x != y and x in y):
                    raise ValueError(f"a text could hide the ends of the markers {x!r} and {y!r}")

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def with_unit_count(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) with ``n``, the number of code points of the text."""
    short = F.regexp_count("text", F.lit(f"(?s){UNIT}"))  # the common case, a text under one block, is counted at once
    blocks = F.regexp_count("text", F.lit(f"(?s){UNIT}{{{BLOCK}}}+")).cast("long") * BLOCK
    behind = F.call_function("regexp_extract", F.col("text"), _concat(r"(?s)\A", _times(F.col("blocks")), r"(.*+)\z"), F.lit(1))
    counted = rows.withColumn("blocks", blocks)
    n = F.when(F.col("blocks") > 0, F.col("blocks") + F.regexp_count(behind, F.lit(f"(?s){UNIT}"))).otherwise(short)
    return counted.select("doc_id", "text", n.cast("long").alias("n"))


def cut_numbers(doc_id: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the sha256 of ``seed:doc_id``, as unsigned integers."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _concat(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _times(count: Column) -> Column:
    return _concat(UNIT + "{", count.cast("string"), "}+")


def cut_pattern(before: Column, middle: Column) -> Column:
    """The row's pattern: ``before`` units, ``middle`` units, the rest."""
    return _concat(r"(?s)\A(", _times(before), ")(", _times(middle), r")(.*+)\z")


def _replacement(*parts: str) -> Column:
    """Markers and group references as a replacement string; markers are taken literally."""
    return F.lit("".join(p if re.fullmatch(r"\$[123]", p) else re.sub(r"([\\$])", r"\\\1", p) for p in parts))


def infill(docs: DataFrame, how: Infilling | None = None) -> DataFrame:
    """(doc_id, text, n, form, prefix_chars, middle_chars, output) of every row of ``docs``."""
    how = how or Infilling()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    h1, h2, h3, h4 = cut_numbers(F.col("doc_id"), how.seed)
    held = [F.contains(F.col("text"), F.lit(m)) for m in how.markers]
    plain = (F.col("n") == 0) | held[0] | held[1] | held[2] | (h3 % 100 >= 100 - how.plain_percent)
    a, b = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    rows = with_unit_count(rows).select(
        "doc_id",
        "text",
        "n",
        F.when(plain, "plain").when(h4 % 100 < how.spm_percent, "spm").otherwise("psm").alias("form"),
        F.least(a, b).alias("a"),
        F.abs(a - b).alias("m"),
    )
    pattern = cut_pattern(F.col("a"), F.col("m"))
    psm = _replacement(how.prefix, "$1", how.suffix, "$3", how.middle, "$2")
    spm = _replacement(how.suffix, "$3", how.prefix, "$1", how.middle, "$2")
    cut = F.regexp_replace(F.col("text"), pattern, F.when(F.col("form") == "psm", psm).otherwise(spm))
    whole = F.col("form") == "plain"
    return rows.select(
        "doc_id",
        "text",
        "n",
        "form",
        F.when(~whole, F.col("a")).alias("prefix_chars"),
        F.when(~whole, F.col("m")).alias("middle_chars"),
        F.when(whole, F.col("text")).otherwise(cut).alias("output"),
    )


def restored(output: Column, form: Column, how: Infilling | None = None) -> Column:
    """The text that ``output`` was made from: the parts between the markers, put back in order.

    The text holds no marker, and no end of a marker is the beginning of one
    (:class:`Infilling` refuses such markers), so none can begin in a part and
    end in the marker behind it: the first match is the right one.
    """
    how = how or Infilling()
    p, s, m = (re.escape(x) for x in how.markers)
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def infill_digests(docs: DataFrame, how: Infilling | None = None) -> DataFrame:
    """:func:`infill` with the SHA-256 of the output and of the text rebuilt from output and form."""
    rows = infill(docs, how)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"), how)).alias("restored_sha256"),
    )


INFILL_SQL = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents
), k AS (
  SELECT doc_id, text, length(text)::BIGINT AS n,
         ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
         ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4
  FROM h
), c AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM k
), o AS (
  SELECT *, substr(text, 1, a) AS p, substr(text, a + 1, b - a) AS m, substr(text, b + 1) AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM o
"""
