"""Monthly-cohort risk analytics on Spark: ingest, clean, label, featurise, train, score, monitor."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions that run in Python workers travel with the job: workers need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
