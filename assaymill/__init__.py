"""Medallion and star-schema data work as plain PySpark functions.

Every function takes DataFrames or Columns and returns DataFrames or Columns.
No session is created here and, apart from the writers in ``sources.sinks`` and
the numbering in ``operators.ordered``, nothing triggers a job.
"""
