"""Operators for preparing training data; nothing outside this subpackage imports it.

Code that runs inside tasks travels with the task, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
