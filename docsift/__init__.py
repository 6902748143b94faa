"""docsift: document search, relevance ranking, bucket aggregations and faceted
navigation over Spark DataFrames.

Everything compiles to Column expressions and DataFrame plans; Catalyst
optimizes, executors do the work.  There is no index and no server.
"""

import sys as _sys

# Functions and classes shipped to Python workers (pandas UDFs, mapInPandas,
# scripted metrics) are pickled by value, so executors need no installed copy
# of this package.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark
    pass

from docsift.session import get_spark, checkpoint_dir  # noqa: F401,E402
from docsift.operators.query import *  # noqa: F401,F403
from docsift.operators.scoring import *  # noqa: F401,F403
from docsift.operators.aggs import *  # noqa: F401,F403
from docsift.operators.sort import Sort  # noqa: F401
from docsift.plans.search import Search, multi_search  # noqa: F401
