"""shopflow: shop-behaviour analytics on Spark DataFrames and Structured Streaming.

Every public function takes DataFrames (and plain parameters) and returns DataFrames;
nothing is collected to the driver. See README.md for the module map.
"""

import sys

from shopflow.session import build_session, prepare, state_root

# Python functions shipped to executors (the pandas aggregate, the per-user state step) are
# pickled with their code, so executors need not have this package installed.
try:
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: executors import the package
    pass

__all__ = ["build_session", "prepare", "state_root"]
