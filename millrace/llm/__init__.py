"""Operators for preparing training text, built on DataFrames and Arrow batches.

Nothing outside this package imports it; ``corpus_pipeline.py`` and the entry
module are its only callers.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so these
# need numpy and pyarrow but not this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
