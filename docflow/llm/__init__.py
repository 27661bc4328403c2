"""Operators for building training data from large text collections.

Each module holds one operator with a general DataFrame interface;
``queries`` applies them to the whole driver tables.  Nothing outside this
subpackage imports it.
"""
