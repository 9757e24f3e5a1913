"""Counterfactual pixel matching on Spark."""
