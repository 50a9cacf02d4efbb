"""Operators for preparing text corpora: extraction, deduplication, scoring, scanning, mixing, archives."""
