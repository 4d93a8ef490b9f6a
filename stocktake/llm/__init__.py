"""Training-data operators: language, tokens, near-duplicates, quality, mixing, search.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to Python workers by value, so a session
# whose workers lack the repository on their path (no --py-files) runs them too.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
