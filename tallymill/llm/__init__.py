"""Operators for preparing language-model training data at scale.

Every operator is a function from DataFrame to DataFrame with its own module;
``queries`` registers one query per operator over the stored tables.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
