"""Readers, series, writers and the retail model over the given tables."""
