"""Readers and decoders that produce canonical frames."""
