"""Operators on whole account tables."""
