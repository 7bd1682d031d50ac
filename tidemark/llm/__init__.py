"""Operators for preparing training text: mixing, filtering, near duplicates, extraction, packing, search.

Nothing else in the package imports this subpackage.
"""
