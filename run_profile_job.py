"""Launcher for spark-submit: ``spark-submit ... run_profile_job.py --config job.properties key=value ...``."""

import sys

from assetlens.app import main

if __name__ == "__main__":
    sys.exit(main())
