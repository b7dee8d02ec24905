"""Fleet diagnostics as Spark DataFrame jobs.

Every job is a plain function from DataFrames to a DataFrame. Nothing runs until
the caller writes or collects the result, except where a docstring says so.
"""

__version__ = "0.1.0"
