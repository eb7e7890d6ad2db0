"""Jobs that chain the operators: ingest, silver, gold, publication."""
