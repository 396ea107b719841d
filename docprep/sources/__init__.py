"""Readers and writers: element JSON, spreadsheets, file listings, sinks."""
