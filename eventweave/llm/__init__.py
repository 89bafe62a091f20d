"""Operators for large text corpora: de-duplication, decontamination, filtering, tokenizing.

Nothing else in the library imports this subpackage, but for the work tables of ``shared``.
"""
