"""Readers that turn raw tables into clean event streams, and writers."""
