"""Composite tables: market prices, regional carbon intensity, hospital readmissions."""
