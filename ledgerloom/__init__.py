"""Feature engineering, profiling and risk scoring on Spark DataFrames.

Every operator takes and returns lazy ``DataFrame`` objects; nothing is
materialised until a sink, a bounded category lookup or a model fit asks for it.
"""
