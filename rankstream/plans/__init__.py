"""Whole queries and jobs put together from the operators."""
