"""Operators for building training data: one module per operator.

Nothing outside this package imports it. ``queries`` binds the operators to
the test tables; ``corpus_pipeline.py`` at the repository top chains five of
them.

Functions of this package travel to the executors by value, so the executors
need the public libraries only, not a copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
