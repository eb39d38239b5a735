"""SQL of the registered queries, for those that SQL can express."""

ORACLE: dict[str, str] = {}
