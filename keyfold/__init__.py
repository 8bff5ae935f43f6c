"""keyfold: keyed event-stream processing on Spark tables and streams."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the workers as code, so a cluster needs no
# copy of it. This also holds for the process that sets up streaming state.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
