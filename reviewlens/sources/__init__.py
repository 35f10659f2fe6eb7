"""Readers and sinks. Only sinks run a job."""
