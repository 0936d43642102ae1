"""Cleaning, normalising and querying place, review and user data on Spark."""
