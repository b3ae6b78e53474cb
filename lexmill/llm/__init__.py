"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it. Each operator module holds a general operator; ``queries``
registers the thin ``opN_*`` queries that apply them to whole tables.
"""
