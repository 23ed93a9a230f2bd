"""Keyed loading and global numbering, usable on any table."""
