"""Training-data operators: deduplication, decontamination, scoring, tokenising, chat and licences.

The package is shipped to the workers by value, so an executor needs no copy of it on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
