"""Raw inputs: explicit schemas, landed-file readers, test-table derivations."""
