"""Operators of a training-data pipeline: quality rules, near-duplicate and
repeat removal, packing, mixing, classifiers, URL rules and exact search.

Each operator is one module with a general function on DataFrames;
``queries`` binds them to the driver's tables. Nothing outside this package
(and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with
# the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
