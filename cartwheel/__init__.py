"""cartwheel: shopping-cart behavioural feature tables on Spark.

Operators are plain ``DataFrame -> DataFrame`` functions (batch and, where
the semantics allow, Structured Streaming). See ``README.md``.
"""

__version__ = "0.1.0"
