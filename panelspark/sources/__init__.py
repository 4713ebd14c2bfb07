"""Inputs and the stored tables."""
