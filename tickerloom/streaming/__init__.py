"""Continuous and scheduled stream runs."""
