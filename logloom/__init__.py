"""Log analytics on Spark: template encoding, wildcard search and timestamp codecs over log tables."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors with their code, so the package needs no
# installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
