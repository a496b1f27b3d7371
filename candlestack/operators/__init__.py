"""DataFrame -> DataFrame operators (no actions, no Python UDFs)."""
