"""Streams of run arrivals."""
