"""Typed CSV scans, the staged raw load and file listings."""
