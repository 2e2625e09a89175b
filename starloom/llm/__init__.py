"""Training-data operators over corpora of documents, pages and conversations."""

import sys

from pyspark import cloudpickle

# What tasks run is sent with them, so executors need the public libraries only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
