"""Readers and writers: files, database tables, replaceable tables, and the star-schema mapping."""
