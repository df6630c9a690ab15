"""Operators of the catalogue engine: images, extraction, assembly, quality, metrics."""
