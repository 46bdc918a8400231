"""Append-only, sequence-numbered event streams as Spark tables."""

import sys

from pyspark import cloudpickle

# Workers on a cluster do not have this package installed: send its classes by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
