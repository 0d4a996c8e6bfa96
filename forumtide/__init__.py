"""Community engagement analytics as PySpark DataFrame jobs.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns; nothing is executed until the caller runs an action. Timestamps are
``TIMESTAMP_NTZ`` values in UTC unless a function says otherwise.
"""
