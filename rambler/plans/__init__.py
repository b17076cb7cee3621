"""End-to-end plans: the three jobs and the registered query catalogue."""
