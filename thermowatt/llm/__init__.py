"""Operators for training-data pipelines: deduplication, search, mixing, archives, language, chat and tokens."""

import sys

from pyspark import cloudpickle

from .queries import ORACLE, QUERIES

# Functions that run in tasks travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def llm_queries():
    return dict(QUERIES)


def llm_oracle():
    return dict(ORACLE)


__all__ = ["llm_oracle", "llm_queries"]
