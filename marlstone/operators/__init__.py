"""See the modules of marlstone.operators."""
