"""casemill: a Spark-native engine for legal text, its knowledge graph and training corpora."""

import sys

from pyspark import cloudpickle

# Executors need not have the package installed: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
