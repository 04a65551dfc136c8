"""DataFrame operators of the bronze -> silver flow."""
