"""Training-data operators: deduplication, tokenizing, filtering, sharding and scoring of documents."""
