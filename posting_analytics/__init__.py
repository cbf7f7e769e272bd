"""Job-posting analytics as PySpark DataFrame operators.

Sub-packages: ``functions`` (Column builders), ``operators`` (DataFrame ->
DataFrame steps), ``sources`` (readers, writers, profiles), ``plans``
(composed flows and test-table queries), ``streaming`` (the same extraction
on streaming frames).
"""

__version__ = "0.1.0"
