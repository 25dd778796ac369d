"""Feature, split, metric, learner and search operators."""
