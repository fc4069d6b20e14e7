"""spark-submit entry point for the named jobs.

    spark-submit --py-files lexispark.zip run_job.py JOB --input ... --output ...

(locally the package next to this file is importable as is).
"""

import sys

from lexispark.plans.jobs import main

if __name__ == "__main__":
    sys.exit(main())
