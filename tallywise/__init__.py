"""Customer analytics and training-data operators on Spark.

Functions of this package that run on executors travel with their tasks: they are pickled by value,
so executors need the libraries it uses but no copy of the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
