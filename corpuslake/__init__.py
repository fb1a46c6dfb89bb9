"""corpuslake: a document lakehouse and retrieval engine expressed as Spark plans."""

import sys

from pyspark import cloudpickle

# Ship the helpers that run inside Arrow tasks by value, so executors need no
# installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
