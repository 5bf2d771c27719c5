"""Functions of tideline."""
