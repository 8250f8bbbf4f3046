"""Catalogue, presence, dimension, document, quality and incremental operators."""
