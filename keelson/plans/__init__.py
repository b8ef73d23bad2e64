"""Registered jobs (``JOBS``) and their DuckDB oracles (``ORACLES``)."""
