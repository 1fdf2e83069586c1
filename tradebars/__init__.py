"""Spark jobs that turn exchange trades into hourly order-flow tables."""
