"""Loads, whole-database jobs and reports."""
