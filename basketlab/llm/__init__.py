"""Operators of a training-data pipeline: extraction, deduplication, fingerprints,
archives, tokenisation, packing and filtering of document corpora.

Nothing else in the library imports this package.  Its Python functions are
pickled by value, so tasks on executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
