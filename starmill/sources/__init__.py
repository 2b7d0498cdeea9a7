"""Bronze readers, gold writers and the table schemas."""
