"""Operators for training-data pipelines; nothing else in caseflux imports them."""
