"""Layered commerce analytics written as Spark DataFrame functions."""

from cartloom.session import configure, shared_dir

__all__ = ["configure", "shared_dir"]
