"""Operators for image and tensor datasets, written as ordinary Spark DataFrame jobs."""

from maskwright.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
