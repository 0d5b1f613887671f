"""Operators of a training-data pipeline over documents, pages and vectors.

Their functions travel to executors by value, so that these need not have the
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
