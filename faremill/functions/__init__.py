"""Column helpers shared by every layer."""
