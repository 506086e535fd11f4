"""Relational operators over trades and bars."""
