"""Operators for preparing training text: filters, near-duplicates, redaction, packing and token files."""
