"""Reusable DataFrame operators: joins, quantiles, checks, profiles, charts, log scan."""
