"""Whole flows, and the catalogue of registered queries with their SQL counterparts."""
