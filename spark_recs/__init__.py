"""spark_recs: interaction-log preparation, top-N recommendation and ranking
evaluation expressed as Spark DataFrame / SQL / MLlib jobs.

Layout
------
sources/    explicit schemas, checked reads, sinks, fixture views, model store
functions/  reusable column expressions (canonical ids, hash keys, dot products)
operators/  the relational and model operators (splits, ids, popularity, ALS,
            blocked scoring, ANN, metrics)
plans/      the registered query catalog, its SQL oracle and plan checks
llm/        operators of a training-data pipeline (optional)
"""

__version__ = "0.1.0"

# Functions that run inside Python workers (tile scoring, hashing) are
# shipped by value, so executors need neither this package installed nor
# a particular working directory.
try:  # pragma: no cover - depends on the PySpark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
