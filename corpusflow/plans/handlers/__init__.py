"""Resolver modules that the registered query loads by name."""
