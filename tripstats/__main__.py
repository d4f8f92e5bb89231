"""``python -m tripstats <stage> ...`` -- see :mod:`tripstats.cli`."""

import sys

from .cli import main

sys.exit(main())
