"""Change streams: parsing, continuous upsert, archiving of consumed files."""
