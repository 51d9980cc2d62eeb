"""Operators for text corpora: filters, near duplicates, repeated passages, decontamination, sharding and packing."""
