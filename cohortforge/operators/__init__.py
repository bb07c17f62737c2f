"""Table operators: aggregates, joins, encoders, profiles, folds, ranks, metrics, models."""
