"""Layered (bronze, silver, gold) indicator tables and reports for Spark."""
