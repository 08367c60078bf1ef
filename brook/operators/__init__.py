"""Bounded operators."""
