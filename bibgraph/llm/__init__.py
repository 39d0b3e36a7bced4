"""Training-data operators: search, packing, de-duplication, fingerprints, scoring, mixing."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its task functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
