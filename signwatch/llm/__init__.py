"""Operators for preparing training data: filters, deduplication, search, scans and tokenizing."""
