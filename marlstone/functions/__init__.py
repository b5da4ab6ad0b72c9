"""See the modules of marlstone.functions."""
