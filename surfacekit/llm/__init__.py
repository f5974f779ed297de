"""Training-data operators on Spark: near-duplicate search, exact substring removal,
benchmark decontamination, classifiers, language identification, HTML extraction, packing,
nearest neighbours, licence scans and dated URL lists.

Nothing else in the library imports this subpackage. Its Python helpers are shipped to the
executors by value, so they need no installation there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
