"""Operators for preparing training text at scale.  Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their code along, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
