"""Fitting and scoring with Spark ML."""
