"""Text-corpus operators for training-data pipelines.

Each module holds one operator with a general interface; ``queries`` registers
the thin ``opN_*`` queries that apply them to the whole ``documents`` table.
Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Worker functions of this package travel by value, so executors need only the
# public libraries and not this repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
