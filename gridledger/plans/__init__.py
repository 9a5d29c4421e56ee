"""Datasets composed from the operators: star schema, metrics, what-if scoring, checks, publishing."""
