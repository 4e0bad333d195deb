"""kestrel: DataFrame-first analytics jobs on Spark.

Every operator is a function from DataFrame(s) to DataFrame; the session is
always passed in by the caller.
"""

__version__ = "0.1.0"
