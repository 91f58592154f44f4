"""Operators for building language-model training data.

Each module is one operator with its own general interface; ``queries``
registers the ``opN_<name>`` queries and their SQL.  Nothing outside this
folder imports it.
"""
