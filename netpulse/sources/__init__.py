"""Scans, table layers, report exports, model and run storage."""
