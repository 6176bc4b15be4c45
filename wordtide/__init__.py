"""wordtide — trending-word analytics for message-board text on Apache Spark.

Layout:
  functions/  column functions (text normalisation, URLs, dates, statistics)
  sources/    table readers and adapters (pages, posts, ledger, dictionary)
  operators/  DataFrame -> DataFrame operators (extraction, terms, daily, weekly, tables)
  plans/      end-to-end daily / weekly jobs and the registered queries
  streaming/  the daily job as an incremental Structured Streaming query
"""

import sys as _sys

# UDFs defined in this package are pickled by value, so executors run them
# without having the package installed (no --py-files needed).
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # older cloudpickle: ship the package with --py-files instead
    pass

from wordtide.session import get_spark, ensure_checkpoint_dir  # noqa: E402

__all__ = ["get_spark", "ensure_checkpoint_dir"]
