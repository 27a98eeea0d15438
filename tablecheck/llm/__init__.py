"""Operators for preparing training data: documents, pages and embeddings at scale.

Nothing else in the library imports this subpackage.  Every operator takes a DataFrame and returns
a DataFrame that holds its key columns and its results only; other columns of the input are ignored,
whatever their names.
"""

import sys

from pyspark import cloudpickle

# Executors need not have the library installed: functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
