"""keelson — fleet-wide software-delivery analytics on Spark.

Subpackages: ``sources`` (fleet tables, task-file scan), ``functions``
(column expressions), ``operators`` (joins, windows, graph loops),
``plans`` (registered jobs and their SQL oracles), ``streaming``
(Structured Streaming twins of the batch jobs).
"""

__version__ = "0.1.0"

# The few functions that run in Python workers (task-file decode, the
# stateful stream) are shipped by value, so executors need no installed copy
# of this package.
try:  # pragma: no cover - depends on the PySpark build
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
