"""larder: recipe data cleaning, enrichment and analysis as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python helpers travel to the workers inside the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
