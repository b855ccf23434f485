"""Group ranking, retweet windows, degrees of separation and sequencing tables on PySpark.

Every operator takes and returns Spark DataFrames. See README.md for the map. Functions
of this package travel to Python workers by value, so workers need not be able to import it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
