"""Whole plans: test views, training, scoring, and the registered queries with their SQL twins."""
