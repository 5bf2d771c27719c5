"""Streaming of tideline."""
