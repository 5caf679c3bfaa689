"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. ``OPERATORS`` of
:mod:`chronolith.llm.queries` names the ten queries built on it.
"""
