"""Realtime transit feeds as Spark tables.

Snapshots of GTFS-Realtime messages go in, typed vehicle and trip tables come
out.  The decode of the wire format runs in Arrow batches; everything else is
DataFrame expressions.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
