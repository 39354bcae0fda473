"""Has no resolver."""
