"""Operators for preparing language-model training text.

Nothing else in the library imports this package. Where an operator runs numpy
inside tasks, Spark reads, partitions and shuffles the rows and a task only ever
sees bounded blocks of them.
"""
