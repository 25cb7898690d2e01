"""Column functions: text clean-up, payload keys and wall-clock time."""
