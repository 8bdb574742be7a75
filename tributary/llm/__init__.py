"""Operators for preparing training data at scale.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when it is present.  One module per operator, ``queries`` registers
them.
"""
