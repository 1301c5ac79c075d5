"""Operators of a training-data pipeline: encoding, packing, de-duplication, filtering, scoring and extraction."""
