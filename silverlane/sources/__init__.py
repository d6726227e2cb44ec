"""Readers and writers: landed JSON, layer tables, tables with a commit history."""
