"""Group counts estimated from a stratified sample, with standard errors and confidence intervals.

Every stratum (month) has a simple random sample of its own, so the strata
that a question leaves out cost nothing and small strata are not at the mercy
of a global draw.  For a group with ``x`` of a stratum's ``n`` sampled rows,
out of ``N``, and ``p = x / n``:

    estimate  sum of N p
    variance  sum of N^2 (1 - n / N) p (1 - p) / (n - 1)

(finite population correction; a stratum of one sampled row out of more has no
variance of its own and counts as p (1 - p)).  The interval is the normal one,
cut at what is certain: a group has at least the rows seen, and at most the
rows of all strata less those seen of other groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .compare import GroupCountQuery
from .sample import STATE_POPULATION

Z_95 = 1.959964  # two-sided 95 % of the normal distribution
DIGITS = 4


def stratum_sizes(states: DataFrame, strata: Sequence[str]) -> DataFrame:
    """(strata, ``_population``, ``_sampled``): one row a stratum."""
    return states.groupBy(*strata).agg(
        F.max(STATE_POPULATION).alias("_population"), F.count(F.lit(1)).alias("_sampled")
    )


def stratified_counts(states: DataFrame, query: GroupCountQuery, strata: Sequence[str], z: float = Z_95) -> DataFrame:
    """(keys, estimated_count, std_error, lower_bound, upper_bound) of every group seen in the sample.

    ``states`` are the rows of :func:`tripstats.operators.sample.sample_states`.
    """
    sizes = stratum_sizes(states, strata)
    totals = sizes.agg(F.sum("_population").alias("_all"), F.sum("_sampled").alias("_all_sampled"))
    renamed = sizes.select(*[F.col(s).alias(f"_s{i}") for i, s in enumerate(strata)], "_population", "_sampled")
    seen = query.domain(states).select(*[F.col(s).alias(f"_t{i}") for i, s in enumerate(strata)], *query.keys)
    seen = seen.groupBy(*[f"_t{i}" for i in range(len(strata))], *query.keys).agg(F.count(F.lit(1)).alias("_x"))
    same = [F.col(f"_t{i}").eqNullSafe(F.col(f"_s{i}")) for i in range(len(strata))]
    # A row a stratum.
    seen = seen.join(F.broadcast(renamed), same)
    p, n, size = F.col("_x") / F.col("_sampled"), F.col("_sampled"), F.col("_population")
    variance = size * size * (1 - n / size) * p * (1 - p) / F.greatest(n - 1, F.lit(1))
    out = seen.groupBy(*query.keys).agg(
        F.sum(size * p).alias("_estimate"), F.sqrt(F.sum(variance)).alias("_error"), F.sum("_x").alias("_seen")
    )
    out = out.join(F.broadcast(totals))  # one row
    most = F.col("_all") - F.col("_all_sampled") + F.col("_seen")
    rounded = lambda c: F.round(c, DIGITS)
    return out.select(
        *query.keys,
        rounded(F.col("_estimate")).alias("estimated_count"),
        rounded(F.col("_error")).alias("std_error"),
        rounded(F.greatest(F.col("_estimate") - z * F.col("_error"), F.col("_seen").cast("double"))).alias("lower_bound"),
        rounded(F.least(F.col("_estimate") + z * F.col("_error"), most.cast("double"))).alias("upper_bound"),
    )
