"""Insurance analytics as Spark DataFrame functions.

``functions``  Column expressions (dates, id cards, dirty amounts, scores)
``operators``  DataFrame -> DataFrame business operators
``sources``    readers, writers and the label store
``streaming``  Structured Streaming jobs
``plans``      stand-in tables and the registry of named queries with their SQL twins
"""
