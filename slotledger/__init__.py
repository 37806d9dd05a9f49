"""Booking and marketing-attribution analytics as lazy Spark DataFrame plans."""
