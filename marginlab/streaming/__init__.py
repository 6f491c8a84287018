"""Recurring work. The closest thing to a stream here is one batch per hour."""
