"""spark-submit entry point for the full build (see starmart.plans.build)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.plans.build import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
