"""Inputs, staged tables and the published warehouse."""
