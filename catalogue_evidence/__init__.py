"""Catalogue evidence: matching catalogue rows to evidence, and publishing only what can be proven."""
