"""Retail demand panels, features and forecasts as Spark DataFrame functions."""
