"""operators of the souk library."""
