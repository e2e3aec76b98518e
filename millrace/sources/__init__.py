"""Scans. Schemas are declared, and remote bodies are read where they were landed."""
