"""Micro-batch execution of the run."""
