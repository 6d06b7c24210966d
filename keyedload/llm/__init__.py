"""Operators of a training-data pipeline over documents: counts, filters, near copies, models, packing."""
