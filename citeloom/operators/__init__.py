"""DataFrame in, DataFrame out: shredding, documents, changes, lookups."""
