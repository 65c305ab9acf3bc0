"""Operators of a training-data pipeline: tokenising, deduplication, chat
formatting, mixing, scoring, secret scans, fingerprints, language ID.

Nothing else in the library imports this subpackage. Its Python tasks are
shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
