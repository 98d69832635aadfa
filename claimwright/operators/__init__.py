"""Claim operators: quality, scoring, reports, features, models and history."""
