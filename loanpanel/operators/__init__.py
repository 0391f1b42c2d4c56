"""DataFrame operators: panel, targets, sampling, economics, features, models, assessment."""
