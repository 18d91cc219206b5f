"""Training-data operators: deduplication, scoring, decontamination, mixing, archives and search.

Each module holds one operator with a general interface; ``queries`` binds them to the
driver's tables. Nothing outside this package imports it except the entry point, which
adds the queries when the package is present.
"""

import sys

from pyspark import cloudpickle

# Executors share no folder with the driver: what tasks use of this package travels with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
