"""Column expressions; each returns a ``Column`` and none runs a job."""
