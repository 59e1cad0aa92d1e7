"""Frozen encoders in numpy, and the registry that pairs them with their front ends."""
