"""Batch jobs."""
