"""Operators of training-data pipelines. Nothing else in the library imports them."""

from pyspark import cloudpickle

import searchmill.llm as _this

# Task functions travel with the job; executors need only the libraries that they use.
cloudpickle.register_pickle_by_value(_this)
