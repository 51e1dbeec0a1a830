"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. The
functions that run inside tasks are shipped by value, so executors need only
PySpark, pyarrow, numpy and the tokenizer libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
