"""Readers, writers, versioned snapshots and derived test fixtures."""
