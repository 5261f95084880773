"""Launcher for ``spark-submit run_job.py {generate|merge} ...`` (see ``critloom/cli.py``)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from critloom.cli import main  # noqa: E402

if __name__ == "__main__":
    main(sys.argv[1:])
