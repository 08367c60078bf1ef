"""brook: event-stream analytics written as PySpark DataFrames and streams.

Each operator has a bounded DataFrame form whose answer is exact and, where a
live feed makes sense, a Structured Streaming form with the same final answer.
"""
