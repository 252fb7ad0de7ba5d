"""Basketry: product-recommendation analytics as plain Spark DataFrame jobs.

Every public function takes DataFrames and returns a DataFrame.  No function
creates a session; the caller's session decides master, memory and shuffle.
"""
