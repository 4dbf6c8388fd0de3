"""strata: Spark-native star-schema, lookup-table and chat-toxicity jobs.

Every public function takes and returns DataFrames (sinks write); nothing is
collected to the driver except bounded size checks.
"""

__all__ = ["session", "schemas"]
