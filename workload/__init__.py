"""The registered queries, over the driver's test tables."""

import importlib

from pyspark import cloudpickle

import aislewise

AREAS = (
    "ledger_queries",
    "sales_queries",
    "stream_queries",
    "graph_queries",
    "document_queries",
    "quality_queries",
    "governance_queries",
    "key_queries",
    "check_queries",
)


def load_all() -> None:
    """Import every area. The package's functions are sent to the workers by value: a session that was
    started elsewhere has workers that cannot import it. A cluster job ships it with ``--py-files``."""
    cloudpickle.register_pickle_by_value(aislewise)
    for area in AREAS:
        importlib.import_module(f"workload.{area}")
