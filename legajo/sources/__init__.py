"""Reading documents and writing texts and records."""
