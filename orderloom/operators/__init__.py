"""Validation, modelling, checks, filters, segment aggregates and global numbering."""
