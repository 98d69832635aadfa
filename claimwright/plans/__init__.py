"""Registered queries with their equivalent SQL."""
