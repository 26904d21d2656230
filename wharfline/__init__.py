"""Bulk line matching and file-inventory work as Spark jobs.

Every operator is a function from DataFrame to DataFrame (or from Column to
Column); only the sinks, the transfer jobs and the functions in ``plans`` run
actions.
"""
