"""Readers: observation files, code lists, and the order tables reshaped as observations."""
