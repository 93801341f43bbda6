"""Part of graphloom."""
