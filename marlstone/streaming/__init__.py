"""See the modules of marlstone.streaming."""
