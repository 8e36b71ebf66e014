"""functions of the souk library."""
