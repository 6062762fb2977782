"""Continuous forms of the batch jobs."""
