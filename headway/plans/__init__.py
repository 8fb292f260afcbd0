"""Whole runs made of several operators."""
