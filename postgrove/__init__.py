"""Analytics over geotagged short posts, in batch and as streams.

Functions that run inside tasks are pickled by value, so executors need the
libraries the functions use but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
