"""clusterlens: k-means clustering, scoring, anomaly flags and report tables
for labelled event records, written as Spark DataFrame operators."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Python workers may not have this package on their path (the driver's
# working directory is not propagated in local mode, and clusters need
# --py-files). Functions of this package used inside UDFs are therefore
# shipped by value.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__version__ = "0.1.0"
