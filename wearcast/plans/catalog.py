"""Imports every checked-query module so their keys register."""

from . import eval_checks, ingest_checks, model_checks, prep_checks, quality_checks, stream_checks, tree_checks  # noqa: F401
from .book import ORACLE, QUERIES  # noqa: F401
