"""River-gauge time-series analytics on Spark.

Every operator takes DataFrames and returns a DataFrame; nothing runs until an
action is called by the job that composes them.
"""
