import sys

from blotter.cli import main

sys.exit(main())
