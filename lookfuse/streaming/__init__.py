"""Enrichment of request streams."""
