"""Readers and writers of pages, manifests, archives and progress."""
