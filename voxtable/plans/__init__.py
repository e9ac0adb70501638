"""Whole stages as lazy plans."""
