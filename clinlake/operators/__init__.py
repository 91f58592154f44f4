"""DataFrame -> DataFrame operators (and fitted-model helpers)."""
