"""Readers: the star model, parameterised SQL, JDBC and seed/derived rows."""
