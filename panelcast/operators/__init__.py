"""Operators over panels ``(keys..., period, values...)``."""
