"""Training-data operators (dedup, joins, PII, WARC, packing, scoring).

Nothing outside this subpackage imports it. Functions that run in Python
workers travel by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
