"""Relational, statistical and model operators over transaction tables."""
