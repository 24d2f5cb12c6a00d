"""Sources: parquet tables, text lines (bounded or streaming), in-memory rows,
Kafka/socket option builders and the seeded sensor source."""
