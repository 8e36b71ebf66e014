"""sources of the souk library."""
