"""Training-data operators: sharding, exact and near deduplication, archives,
quality rules, personal data, page extraction, decontamination and packing.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  The
functions that run inside Spark tasks are shipped by value, so executors do not
need this repository on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
