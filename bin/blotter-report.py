"""spark-submit entry point: spark-submit --py-files blotter.zip bin/blotter-report.py <report> ..."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blotter.cli import main  # noqa: E402

sys.exit(main())
