from cartpulse.sources.tables import load_table  # noqa: F401
