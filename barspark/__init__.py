"""barspark: point-in-time market-bar features, labels, scoring and monitoring on Spark."""

import sys as _sys

__version__ = "0.1.0"

# Python workers on a cluster do not have this package installed: ship the code inside the
# pickled UDFs (by value) instead of by import path.
try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
