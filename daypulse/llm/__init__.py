"""Operators of a training-data pipeline: dedup, filters, packing, classifiers, search.

Nothing else in the library imports this package; ``queries.py`` holds its
registered queries and ``corpus_pipeline.py`` at the repository top chains them.
The package's functions travel to executors with their tasks, so executors
need only the public libraries installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
