"""DataFrame -> DataFrame operators. Keys start with ``match_id``."""
