"""Registered queries: each binds an operator to the driver tables.

A module per family; ``registry`` collects the callables and their SQL twins.
"""
