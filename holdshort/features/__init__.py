"""Splits, encoders and resampling ahead of model fitting."""
