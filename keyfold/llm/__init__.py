"""Operations of a large-scale training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage. ``queries.py`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
