"""Text classification on Spark: cleaning, TF-IDF, classifiers, search and reports.

Every operator takes and returns DataFrames.  The sub-packages are

* ``functions``  column expressions (text, hashing, arithmetic)
* ``sources``    table readers, the cleaned-text cache and the sinks
* ``operators``  one DataFrame transformation each
* ``plans``      workflows made of several operators
* ``workload``   the registered queries and their SQL twins
"""

import sys

from pyspark import cloudpickle

# Functions for the executors travel with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
