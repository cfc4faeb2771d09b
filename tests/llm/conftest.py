"""Helpers of the operators' tests; the session comes from the folder above."""
