"""Runs the library on the supplied test tables and states the expected results in SQL."""
