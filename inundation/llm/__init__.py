"""Operators of a training-data pipeline, one module each, and the queries that apply them.

Nothing outside this package imports it.  Texts are cut into words by one rule, ``[^\\x20\\x09-\\x0D]+``, in ``flat``.
"""
