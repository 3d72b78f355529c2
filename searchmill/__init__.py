"""Search-analytics exports to daily facts, on Spark."""

import sys

from pyspark import cloudpickle

from searchmill.plans.load import export_facts, load_exports, run, seed_history
from searchmill.schemas import Mart, create_layers
from searchmill.sinks.tables import append_facts, refresh_clean, replace_by_date, seed_raw
from searchmill.streaming.ingest import ingest

# Task functions travel with the job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "Mart",
    "append_facts",
    "create_layers",
    "export_facts",
    "ingest",
    "load_exports",
    "refresh_clean",
    "replace_by_date",
    "run",
    "seed_history",
    "seed_raw",
]
