"""Operations for preparing training text: extraction, deduplication, quality,
decontamination, mixing and sharding over the ``documents``-like tables.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value: executors need no copy of this
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
