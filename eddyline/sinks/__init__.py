"""Sinks: print, Kafka payload, hash upsert, index append, JDBC upsert and custom
open/process/close writers. Writers run per partition on executors with batched
round trips; upserts take the last record per key first, so replays are safe."""
