"""Columns: grids, codecs, map algebra."""
