"""Operators for preparing training text, one module each.

Nothing else in the library imports this subpackage.  ``queries`` registers
one query per operator; ``corpus_pipeline.py`` at the repository top chains
five of them.

Functions that run in Python workers are sent with the job (by value), so
executors need the packages listed in the README, but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
