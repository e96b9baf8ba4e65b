"""Transforms from frames to frames: statements, valuation, market analytics, news, macro series."""
