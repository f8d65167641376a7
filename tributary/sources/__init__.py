"""Inputs: document files, archives and monthly tables."""
