"""Spark building blocks of pointmill."""
