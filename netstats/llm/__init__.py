"""Operators for preparing training text: duplicates, quality, language, tokens, archives.

Nothing else in the library imports this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Tasks get the package's functions by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
