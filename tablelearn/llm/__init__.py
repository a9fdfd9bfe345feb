"""Training-data operators: tokenisation, filtering, deduplication, search and sharding."""
