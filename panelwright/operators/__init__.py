"""DataFrame -> DataFrame operators, keyed by entity, time and value columns."""
