"""Reading tables, change files, metadata and source databases."""
