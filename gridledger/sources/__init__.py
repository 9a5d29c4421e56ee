"""Readers of the raw zone and of the driver's tables."""
