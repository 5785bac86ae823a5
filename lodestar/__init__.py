"""lodestar: analytics jobs as Spark DataFrame jobs.

Subpackages
-----------
sources    readers and writers (delimited text, CSV, model persistence)
functions  column expressions (vectors, flag labels)
operators  splits, lookups, statistics, ranking, models
plans      working relations derived from the driver tables, registered
           queries and their DuckDB oracles
llm        training-data operators (optional: nothing else imports it)
"""

__version__ = "0.1.0"
