"""Operators that prepare text for training: packing, leak search and repair of wrongly decoded text."""
