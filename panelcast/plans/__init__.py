"""Stage plans and the registered query catalog."""
