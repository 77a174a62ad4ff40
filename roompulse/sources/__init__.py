"""Readers for files, JSON topics, Kafka and JDBC."""
