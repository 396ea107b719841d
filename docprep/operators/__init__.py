"""DataFrame operators: sections, chunks, media reconciliation, QA rows, metrics, nested records."""
