"""The query catalogue: one function per query, with its SQL answer."""
