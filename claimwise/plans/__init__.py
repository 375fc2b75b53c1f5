"""Stand-in frames over the driver tables and the registered queries."""
