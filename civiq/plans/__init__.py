"""Batch jobs composed of the operators. The caller owns the session."""
