"""townpull: gazetteer metro assignment on Spark."""

import sys as _sys

# Functions shipped to Python workers (the Arrow evaluation engines, the zip reader)
# are pickled by value together with the package code they call, so executors do not
# need this package installed or on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: workers then need the package installed
    pass
