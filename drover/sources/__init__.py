"""Readers that turn raw files or text columns into typed tables, and sinks."""
