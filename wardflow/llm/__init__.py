"""Operators for preparing training text: extraction, filtering, deduplication and encoding."""
