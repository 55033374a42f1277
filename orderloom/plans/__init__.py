"""Whole jobs: loading, KPIs on two paths, insights, reports and reconciliation."""
