"""blotter: incident analytics on Spark DataFrames.

Every operation is a plain function from DataFrames to a DataFrame, built from
native column expressions so that Catalyst can prune, push down and codegen the
whole plan. Subpackages:

- ``sources``   readers with declared schemas (CSV extracts, text lines, parquet)
- ``functions`` column expressions (date text, money text, part of day, distance)
- ``operators`` reusable relational building blocks (top-n, sites, dedupe)
- ``plans``     the report queries and their SQL forms
- ``streaming`` the same reports over a growing directory of extracts
"""

from blotter.session import checkpoint_dir, local_session

__all__ = ["checkpoint_dir", "local_session"]
