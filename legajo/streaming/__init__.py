"""Files handled as they arrive."""
