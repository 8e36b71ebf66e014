"""streaming of the souk library."""
