"""Readers and writers of deliveries: contract CSV, JSON lines, manifests, atomic folders, immutable registers."""
