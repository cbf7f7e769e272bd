"""Composed flows and the queries bound to the driver's test tables."""
