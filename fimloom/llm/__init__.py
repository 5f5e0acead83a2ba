"""Operators of a large-scale training-data pipeline (URL filters, packing, dedup, scans, language models)."""
