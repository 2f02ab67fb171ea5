"""Scans, input detection, integrity checks and stage artifacts."""
