"""Package part; see the modules."""
