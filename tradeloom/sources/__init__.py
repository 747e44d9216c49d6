"""Readers: files, Kafka, JDBC and literal lookups."""
