"""Sources of tideline."""
