"""Review analytics as lazy PySpark DataFrame operators.

``functions``  Column expressions (casts, predicates, text, time, sentiment)
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers and sinks
``plans``      whole jobs put together from operators
"""

from reviewlens.schema import REVIEW, ReviewColumns

__all__ = ["REVIEW", "ReviewColumns"]
