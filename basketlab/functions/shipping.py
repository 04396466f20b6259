"""Make the Python-side group functions runnable on workers that cannot import basketlab.

The Arrow group functions (exact Gram products, the basket solver) are
serialised by value, so executors only need numpy and pandas, not this
package on their path. On a cluster, shipping the package with
``--py-files`` works as well; this removes the requirement.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    module = sys.modules[module_name]
    try:
        cloudpickle.register_pickle_by_value(module)
    except ValueError:  # already registered
        pass
