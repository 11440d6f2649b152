"""recspark: labelled, queryable tables of multi-channel recordings on Spark.

Every public function takes and returns DataFrames (or Columns); nothing holds
a session. See README.md for the module map.
"""

__version__ = "0.1.0"
