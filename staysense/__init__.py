"""Booking-cancellation analytics on Spark.

Functions of this package that run on executors are pickled by value, so the
package itself need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
