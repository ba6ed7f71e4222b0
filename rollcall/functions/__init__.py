"""Part of rollcall; see README."""
