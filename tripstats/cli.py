"""Command line: the pipeline stages as separate jobs, or all at once.

    tripstats_job.py ingest    --raw R --bronze B
    tripstats_job.py clean     --bronze B --silver S --sample P [--sample-size N]
    tripstats_job.py validate  --silver S --report Q
    tripstats_job.py analytics --silver S --sample P --gold G [--eps E --confidence C --cms-seed K]
    tripstats_job.py run       --raw R --out O

On a cluster: ``spark-submit --py-files tripstats.zip tripstats_job.py <stage> ...``
(the submitted master and settings are kept); locally ``python -m tripstats
<stage> ...`` starts a local session.  Each stage reads its
input layer from storage and writes its output layer, so stages can run as
separate jobs.  A failed quality check exits with 2, stored sketches that do
not match silver with 3.  Sample and sketch
parameters default to the environment variables ``TARGET_SAMPLE_SIZE``,
``CMS_EPSILON``, ``CMS_CONFIDENCE`` and ``CMS_SEED`` when set.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from .operators.clean import HALF_OPEN, INCLUSIVE_MIDNIGHT
from .operators.quality import QualityGateError
from .operators.sketch import SketchParams
from .plans import pipeline as P
from .schemas import (
    DEFAULT_CMS_CONFIDENCE,
    DEFAULT_CMS_EPS,
    DEFAULT_CMS_SEED,
    DEFAULT_DATE_HI,
    DEFAULT_DATE_LO,
    DEFAULT_SAMPLE_SEED,
    DEFAULT_SAMPLE_SIZE,
)
from .session import build_session
from .sources.month_store import StaleMonths


def _env(name: str, default, cast):
    value = os.environ.get(name)
    return cast(value) if value not in (None, "") else default


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tripstats", description=__doc__.split("\n\n")[0])
    sub = ap.add_subparsers(dest="stage", required=True)

    def clean_args(p):
        p.add_argument("--date-lo", default=DEFAULT_DATE_LO)
        p.add_argument("--date-hi", default=DEFAULT_DATE_HI)
        p.add_argument("--range-mode", choices=[INCLUSIVE_MIDNIGHT, HALF_OPEN], default=INCLUSIVE_MIDNIGHT)
        p.add_argument("--dedup", action="store_true")
        p.add_argument("--sample-size", type=int, default=_env("TARGET_SAMPLE_SIZE", DEFAULT_SAMPLE_SIZE, int))
        p.add_argument("--sample-seed", type=int, default=DEFAULT_SAMPLE_SEED)

    def sketch_args(p):
        p.add_argument("--eps", type=float, default=_env("CMS_EPSILON", DEFAULT_CMS_EPS, float))
        p.add_argument("--confidence", type=float, default=_env("CMS_CONFIDENCE", DEFAULT_CMS_CONFIDENCE, float))
        p.add_argument("--cms-seed", type=int, default=_env("CMS_SEED", DEFAULT_CMS_SEED, int))
        p.add_argument("--times", action="store_true", help="run, write and time each method on its own")
        p.add_argument("--no-times", action="store_true", help="accepted and ignored: times are off by default")
        p.add_argument("--months", nargs=2, metavar=("FIRST", "LAST"),
                       help="restrict gold to pickup months FIRST..LAST (dates); prunes partitions")

    p = sub.add_parser("ingest", help="raw CSV -> bronze Parquet")
    p.add_argument("--raw", required=True)
    p.add_argument("--bronze", required=True)

    p = sub.add_parser("clean", help="bronze -> silver (partitioned) + sample")
    p.add_argument("--bronze", required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--sample", required=True)
    p.add_argument("--incremental", action="store_true", help="replace only the months of bronze in silver")
    clean_args(p)

    p = sub.add_parser("validate", help="quality gate over silver")
    p.add_argument("--silver", required=True)
    p.add_argument("--report", required=True)

    p = sub.add_parser("analytics", help="silver + sample -> gold comparisons and metrics")
    p.add_argument("--silver", required=True)
    p.add_argument("--sample", required=True)
    p.add_argument("--gold", required=True)
    p.add_argument("--sketches", help="use the monthly sketches stored there by the sketches stage")
    sketch_args(p)

    p = sub.add_parser("sketches", help="silver -> one stored sketch for each question and month")
    p.add_argument("--silver", required=True)
    p.add_argument("--sketches", required=True)
    sketch_args(p)

    p = sub.add_parser("run", help="all stages under one root")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--min-files", type=int, default=1)
    p.add_argument("--quarantine", action="store_true", help="move rows that break a row rule out of silver, by reason")
    p.add_argument("--gate-last", action="store_true", help="run the gate after gold instead of before")
    clean_args(p)
    sketch_args(p)
    return ap


def _sketch_params(args) -> SketchParams:
    return SketchParams(args.eps, args.confidence, args.cms_seed, P.PIPELINE_SKETCH.hash)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or build_session()
    out: dict = {"stage": args.stage}
    try:
        if args.stage == "ingest":
            out["bronze_rows"], out["malformed_rows"] = P.ingest(spark, args.raw, args.bronze)
        elif args.stage == "clean":
            out["silver_rows"] = P.build_silver(
                spark, args.bronze, args.silver, args.date_lo, args.date_hi, args.range_mode, args.dedup, args.incremental
            )
            out["sample_rows"] = P.build_sample(spark, args.silver, args.sample, args.sample_size, args.sample_seed).size
        elif args.stage == "validate":
            out["row_count"] = P.run_gate(spark, args.silver, args.report)
        elif args.stage == "analytics":
            out["metrics"] = P.build_gold(
                spark, args.silver, args.sample, args.gold, _sketch_params(args), measure_times=args.times,
                months=tuple(args.months) if args.months else None, sketch_path=args.sketches,
            )
        elif args.stage == "sketches":
            done = P.build_sketches(spark, args.silver, args.sketches, _sketch_params(args),
                                    months=tuple(args.months) if args.months else None)
            out["recomputed_months"] = {name: len(found) for name, found in done.items()}
        else:
            res = P.run_pipeline(
                spark,
                args.raw,
                args.out,
                sample_size=args.sample_size,
                sample_seed=args.sample_seed,
                params=_sketch_params(args),
                date_lo=args.date_lo,
                date_hi=args.date_hi,
                range_mode=args.range_mode,
                dedup=args.dedup,
                min_files=args.min_files,
                gate_before_gold=not args.gate_last,
                quarantine=args.quarantine,
                measure_times=args.times,
                months=tuple(args.months) if args.months else None,
            )
            out.update(status=res.status, counts=res.counts, metrics=res.metrics)
    except QualityGateError as exc:
        print(json.dumps({"stage": args.stage, "error": str(exc)}), file=sys.stderr)
        return 2
    except StaleMonths as exc:
        print(json.dumps({"stage": args.stage, "error": str(exc)}), file=sys.stderr)
        return 3
    print(json.dumps(out, default=str))
    return 0
