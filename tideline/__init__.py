"""Change-data and event-stream analytics on PySpark.

Operators are functions over DataFrames: Catalyst plans them, executors run
them. ``operators`` holds the batch forms, ``streaming`` the Structured
Streaming forms, ``plans`` the keyed tables, the database synchronisation and
the registered contract queries.
"""

__version__ = "0.1.0"
