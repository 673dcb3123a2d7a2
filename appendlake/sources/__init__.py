"""Readers: manifest, file listing, growing CSV files, option labels."""
