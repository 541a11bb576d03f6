"""DataFrame -> DataFrame operators. All are lazy."""
