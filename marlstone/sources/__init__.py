"""See the modules of marlstone.sources."""
