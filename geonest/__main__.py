"""``python -m geonest <command> ...``: see geonest.cli."""

import sys

from geonest.cli import main

sys.exit(main())
