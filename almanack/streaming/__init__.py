"""File-source streaming runner for the silver merge."""
