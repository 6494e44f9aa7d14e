"""Training-data operators: near duplicates, scoring, encoding, filtering, mixing, search.

Nothing else in the library imports this subpackage; its queries are in
``tryline.llm.queries``.
"""

import sys

from pyspark import cloudpickle

# task functions travel with the job: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
