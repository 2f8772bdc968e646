"""Readers and writers: feeds, raw zone, staging, snapshots."""
