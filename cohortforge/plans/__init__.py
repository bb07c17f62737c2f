"""Feature plans: reference-shaped blocks, the wide feature build, train and score jobs,
and the registered queries over the driver's tables."""
