"""Column expressions, and functions to register with a session."""

from tidemark.functions.expressions import bucket_start, change, clamp, discounted, text_key

__all__ = ["bucket_start", "change", "clamp", "discounted", "text_key"]
