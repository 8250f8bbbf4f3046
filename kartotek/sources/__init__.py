"""Readers: landed bodies in, typed rows out. Rejected bodies go to quarantine rows."""
