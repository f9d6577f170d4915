"""Loan-collections analytics as Spark DataFrame operators.

``sources``    reading, checking and writing the five raw tables and the results
``functions``  column helpers and whole-table orderings shared by the operators
``operators``  one module per step: features, quality, scorecard, metrics, policy ...
``plans``      the steps put together
"""

import sys

from pyspark import cloudpickle

# Python functions that run inside tasks travel with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
