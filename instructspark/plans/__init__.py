"""Whole jobs: improve, prepare, distil, score."""
