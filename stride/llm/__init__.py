"""Operators for building a language-model training corpus, one module per operator.

Nothing else in the library imports this subpackage.  Functions that run inside
tasks are pickled by value, so executors need numpy / pyarrow (and `tokenizers`
for packing) but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
