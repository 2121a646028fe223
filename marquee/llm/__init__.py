"""Training-data operators over a table of documents (doc_id, text, ...).

Nothing else in the library imports this subpackage. Operators take and return
DataFrames; ``queries`` holds the registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code with them, so executors
# need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
