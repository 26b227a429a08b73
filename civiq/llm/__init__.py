"""Operators for training-data pipelines.

Functions of this package travel to the executors by value, so that a cluster needs no copy of it
installed. State that is costly to build (automata, vocabularies, caches) is broadcast as plain data:
a Python worker unpacks a broadcast once and keeps it for all its tasks.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
