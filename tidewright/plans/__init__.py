"""Registered queries with their SQL twins, and the table bindings they use."""
