"""cohortforge: customer-level feature building and scoring on Spark DataFrames.

A wide table is built from one application table and several one-to-many
history tables: each history is reduced to one row per customer with
declarative aggregate specs, the results are left-joined onto the
application rows, then encoded, pruned, filled, scaled, split into folds and
scored with Spark ML.  Every step is a DataFrame expression; nothing is
collected except one-row profiles (column counts, never row counts).
"""

from cohortforge.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
