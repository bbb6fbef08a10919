"""Spark-native tables and operators for molecular-dynamics trajectory data."""
import sys

from pyspark.cloudpickle import register_pickle_by_value

# the small functions that run in Python tasks travel with the job, so workers
# do not need the package on their path
register_pickle_by_value(sys.modules[__name__])
