"""Analytics tables on Spark: load, stage, join, roll up, keep, and check.

Every public function takes and returns DataFrames and stays lazy unless its
name says that it writes.
"""
