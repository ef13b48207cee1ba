"""Batch and incremental data feeds as Spark jobs.

Every operator takes and returns DataFrames and answers for all loads, files or
keys in one job. Nothing here keeps state of its own: "now", run dates and
locations are parameters, so that results can be reproduced.
"""
