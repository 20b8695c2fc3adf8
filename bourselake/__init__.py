"""Bourselake: a market-data lake on Spark.

Calendars, futures contracts, date coverage, catalog upkeep and load planning
are all DataFrame operators over tables of (dataset, symbol, schema) keys.
"""
