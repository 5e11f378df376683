"""Inputs and outputs."""
