"""Warehouse builds, validation, reports and KPIs."""
