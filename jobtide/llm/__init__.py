"""Training-data operators: one module per operator, each with its general interface; ``queries`` has the registered
queries over the given tables and ``oracles`` the SQL they are checked against. Nothing else in the library imports it.
"""

import sys

from pyspark import cloudpickle

# Executors get the functions of these modules with the task and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
