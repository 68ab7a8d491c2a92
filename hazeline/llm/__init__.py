"""Operators for building training corpora; nothing else in hazeline imports this."""
