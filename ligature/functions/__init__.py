"""Part of ligature."""
