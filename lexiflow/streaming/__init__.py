"""Structured Streaming: scoring texts with fitted models."""
