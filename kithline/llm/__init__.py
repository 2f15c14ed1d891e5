"""Operators for large-scale training-data preparation on Spark.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; intermediate tables go to the folder that the session names
in ``spark.checkpoint.dir`` so that lost executors only cost recomputation.
"""
