"""Whole jobs and registered queries composed from the operators."""
