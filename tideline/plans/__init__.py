"""Plans of tideline."""
