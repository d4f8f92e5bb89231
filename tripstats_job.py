"""spark-submit entry point: ``spark-submit --py-files tripstats.zip tripstats_job.py <stage> ...``."""

import sys

from tripstats.cli import main

if __name__ == "__main__":
    sys.exit(main())
