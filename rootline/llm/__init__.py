"""Training-data operators: extraction, filtering, deduplication, search and packing of documents.

Nothing outside this package imports it.  Functions that run on executors, and the values they are sent (shared.Sent),
carry their code with them, so a cluster needs no copy of the package on its Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
