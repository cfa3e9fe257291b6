"""Part of lectio."""
