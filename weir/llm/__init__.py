"""Operators of a training-data pipeline (de-duplication, quality, licences,
mixing, packing, token files) over the ``documents`` / ``embeddings`` tables.

Nothing else in the library imports this subpackage.
"""
