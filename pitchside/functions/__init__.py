"""Column helpers and text scoring."""
