"""Whole jobs: read the sources, run the operators, write the results."""
