"""The sales tables, layer by layer."""
