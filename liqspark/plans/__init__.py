"""End-to-end jobs, test-table proxies and the registry of named queries."""
