"""Readers of job records, registries, affiliations, state and logs."""
