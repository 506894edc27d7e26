"""Scoring of account streams with row-local transformers."""
