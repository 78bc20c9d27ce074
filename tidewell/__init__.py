"""Spark engine for sensor time series that arrive from many providers.

Every operator takes DataFrames and returns a DataFrame (or takes and returns
Columns).  A series is a set of key columns, never a frame of its own, so one
call handles all series at once.  See README.md for the layout of the data and
for how one very long series is spread over many tasks.
"""
