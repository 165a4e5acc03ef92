"""Batch fraud analytics on Spark: profile, engineer, split, rebalance, fit, threshold and grade transactions."""
