"""sparkfeat: feature, evaluation and compression operators on Spark DataFrames.

Every operator takes a DataFrame plus column names and returns a DataFrame
(or a fitted transform whose ``transform`` returns one).  The heavy work runs
as Spark jobs: aggregations, joins, windows and Arrow-batched pandas functions
on executors.  The driver only ever holds bounded metadata (one-row statistics,
category lists, range-partition offsets, model coefficients).
"""

__version__ = "0.1.0"

# Functions of this package that run inside pandas UDFs are pickled by value,
# so executors need no installed copy of the package.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
