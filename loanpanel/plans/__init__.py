"""Jobs that chain the operators: build data, fit, correct, assess."""
