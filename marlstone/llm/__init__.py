"""Operators of a training-data pipeline; registry.py lists their queries."""
