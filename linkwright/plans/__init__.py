"""Composed plans: configuration, run budget, model search, stages, registered queries."""
