"""Operators of tideline."""
