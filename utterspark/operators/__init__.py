"""DataFrame operators: corpus, ranking/splitting, labels, features, scoring,
decisions, metrics and model fitting."""
