"""Named views and jobs over the banking tables."""
