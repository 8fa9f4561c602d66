"""Operators: functions from DataFrames to DataFrames, and write actions."""
