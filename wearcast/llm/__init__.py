"""Training-data operators (deduplication, decontamination, sharding, PII,
packing, quality, formatting, licenses).  Nothing else in the library imports
this subpackage."""
