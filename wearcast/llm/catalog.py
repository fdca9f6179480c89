"""Imports every query module so that its queries register."""

from . import chat, compression, decontaminate, infill, jaccard, licenses, near_vectors, packing, pii  # noqa: F401
from . import quality_rules, sharding, suffixes, whitening  # noqa: F401
from .book import ORACLE, QUERIES  # noqa: F401
