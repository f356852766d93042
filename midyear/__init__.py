"""midyear: demographic table operators for PySpark.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns).  Nothing is computed until an action, except where a docstring says
that a function runs a job.
"""
