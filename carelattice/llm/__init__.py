"""Operators for preparing training corpora: cleaning, deduplication, scoring, formatting, packing.

Nothing else in the package imports this subpackage; it may be removed as a whole.
"""
