"""Readers and writers: raw inputs, dated tables, and the test-table bindings."""
