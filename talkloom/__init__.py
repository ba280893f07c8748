"""Talk-catalog analytics on PySpark.

Every capability is a plain function from DataFrames to a DataFrame; nothing
here runs a Spark job by itself except the sinks and the jobs in ``plans``.
"""
