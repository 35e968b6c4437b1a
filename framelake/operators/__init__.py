"""Frame-level operators (DataFrame -> DataFrame)."""
