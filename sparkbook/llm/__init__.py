"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; its thin ``opN_*`` query lives in ``catalog``.
"""
