"""Monthly sketches that follow a published stream: the cells of new batches are added to the stored ones.

A month's stored cells name the silver folder they stand for.  Silver's
manifest says up to which batch that folder went and up to which the current
one goes, so the batches between the two are what the cells lack.  The sum is
published with the current folder's name.  A batch is therefore counted once,
whenever the job runs and however often: cells that stand for the current
folder are left alone, and a job killed before its manifest file is written
has changed nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.compare import GroupCountQuery, sketch_cells_for
from ..operators.sketch import SketchParams, cms_merge
from ..plans.monthly import CELL_SCHEMA, refresh_sketch, sketch_folder
from ..schemas import SILVER_PARTITION_COLUMNS
from ..sources.month_store import Month, MonthEntry, MonthStore, only_months, stale_months
from .ingest import BATCH, landed_rows


class Merged(NamedTuple):
    """Months whose cells were added to from batches, and months computed anew from silver."""

    added: list[Month]
    recomputed: list[Month]


def _gap(history: Sequence[MonthEntry], folder: str | None) -> tuple[int, int, int] | None:
    """(last batch in ``folder``, last batch now, rows between) of a month; None if batches do not explain it."""
    place = next((i for i, e in enumerate(history) if e.folder == folder), None)
    if place is None or any(e.source is None for e in history[place:]):
        return None  # not a folder of this layer, or written by something else than the stream
    old, new = history[place], history[-1]
    if int(old.source) >= int(new.source):
        return None
    return int(old.source), int(new.source), new.row_count - old.row_count


def _between(landed: DataFrame, gaps: Mapping[Month, tuple[int, int, int]]) -> DataFrame:
    """The landed rows that each month's cells lack."""
    wanted = F.lit(False)
    for (year, month), (old, new, _) in gaps.items():
        here = F.col("year").eqNullSafe(F.lit(year)) & F.col("month").eqNullSafe(F.lit(month))
        wanted = wanted | (here & (F.col(BATCH) > old) & (F.col(BATCH) <= new))
    return landed.where(wanted)


def _explained(
    spark: SparkSession, silver_dir: str, gaps: Mapping[Month, tuple[int, int, int]]
) -> tuple[DataFrame | None, dict[Month, tuple[int, int, int]]]:
    """The landed rows, and the months whose growth they are, row for row.

    A month from which rows were taken since (a quarantine) has grown by less.
    """
    if not gaps:
        return None, {}
    first, last = min(g[0] for g in gaps.values()) + 1, max(g[1] for g in gaps.values())
    try:
        landed = landed_rows(spark, silver_dir, first, last)
    except AnalysisException as e:  # landed batches have been cleared away
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, {}
    counts = _between(landed, gaps).groupBy(*SILVER_PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a month
    found = {(r["year"], r["month"]): r["n"] for r in counts}
    return landed, {m: g for m, g in gaps.items() if found.get(m, 0) == g[2]}


def merge_into(
    spark: SparkSession, silver_dir: str, path: str, query: GroupCountQuery, params: SketchParams
) -> Merged:
    """Bring the stored cells of a question at ``path`` up to date with a published stream.

    Months that batches explain cost those batches; other stale months (new
    ones, rewritten ones, those whose batches are gone) are computed from
    silver.  Equal to the cells of a batch run over the whole layer.
    """
    store, silver = MonthStore(spark, path), MonthStore(spark, silver_dir)
    have = store.entries()
    source = silver.identities()
    stale = [m for m in stale_months(have, source) if m in have and m in source]
    history = silver.history(stale)
    gaps = {m: gap for m in stale if (gap := _gap(history[m], have[m].source)) is not None}
    landed, gaps = _explained(spark, silver_dir, gaps)
    if gaps:
        old = only_months(store.read(CELL_SCHEMA), gaps)
        fresh = sketch_cells_for(query, _between(landed, gaps).drop(BATCH), params, group_cols=SILVER_PARTITION_COLUMNS)
        cells = cms_merge(old, fresh.select(*CELL_SCHEMA.names), group_cols=SILVER_PARTITION_COLUMNS)
        # The folder that the batches lead to, which a publication under way may already have replaced.
        store.write(cells.select(*CELL_SCHEMA.names), months=gaps, sources={m: history[m][-1].folder for m in gaps})
    return Merged(sorted(gaps, key=str), refresh_sketch(spark, silver_dir, path, query, params))


def merge_published(
    spark: SparkSession, silver_dir: str, root: str, params: SketchParams, queries: Sequence[GroupCountQuery]
) -> dict[str, Merged]:
    """:func:`merge_into` of several questions under one root, by question; to be given as ``on_publish``."""
    return {
        q.name: merge_into(spark, silver_dir, sketch_folder(root, i, params), q, params) for i, q in enumerate(queries, start=1)
    }
