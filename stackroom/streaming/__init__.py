"""The clean layers on files that keep arriving."""
