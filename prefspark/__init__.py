"""Preparation of instruction and preference tables on Spark."""
