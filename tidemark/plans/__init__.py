"""Whole jobs built from the operators, named views, and the catalogue of queries with their SQL twins."""
