"""Marginalia: a contest corpus engine on Spark."""
